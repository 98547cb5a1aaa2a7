"""Python workers must be able to import this package."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def on_one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package. On one machine its folder joins the path that workers get; on a cluster, whose nodes need not have it, it goes to every executor as a zip in the shared folder."""
    sc = spark.sparkContext
    if on_one_machine(spark):
        env = sc.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if ROOT not in paths:
            env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    elif not any(p.startswith("beacongrid-") for p in sc._python_includes):
        data = packed()
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared(spark)}/beacongrid-{hashlib.sha256(data).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}.zip")
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(data))
        out.close()
        sc.addPyFile(path.toString())
    return spark


def packed() -> bytes:
    """The package's modules as a zip that Python can import from; the same bytes for the same modules."""
    package, to = os.path.join(ROOT, "beacongrid"), io.BytesIO()
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for at, folders, files in os.walk(package):
            folders[:] = sorted(f for f in folders if f != "__pycache__")
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(at, name)
                with open(path, "rb") as f:
                    z.writestr(zipfile.ZipInfo(os.path.relpath(path, ROOT)), f.read(), zipfile.ZIP_DEFLATED)
    return to.getvalue()


def settled(df: DataFrame) -> DataFrame:
    """df, computed once: a checkpoint in the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint()


def shared(spark: SparkSession) -> str:
    """The folder all nodes share: spark.checkpoint.dir. Where that is unset, a temporary folder on a single machine; on a cluster that is an error."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not on_one_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="beacongrid-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")
