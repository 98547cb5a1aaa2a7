"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..session import reachable

#: Batches of texts for Python workers, where the session has Spark's defaults.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
#: No key of a join's rows may hold more than this part of them and still be shuffled: there are at most so many such keys, so they are broadcast.
HOT = 4096
#: Rows of a few numbers that are sent to where others are, instead of shuffling those.
MOST_IDS = 1 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package. Every operator calls it; the session's settings stay."""
    return reachable(spark)


def small_batches(spark: SparkSession) -> SparkSession:
    """For the queries and the pipeline, which own their session: bounds what a batch of texts takes, unless set otherwise."""
    for key, most in ARROW.items():
        if spark.conf.get(key) == spark._jvm.org.apache.spark.sql.internal.SQLConf().getConfString(key):
            spark.conf.set(key, most)
    return ready(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every node shares: spark.checkpoint.dir. Where it is unset, a temporary one on a single machine; on a cluster that is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    at = sc._jsc.sc().getCheckpointDir()
    if not at.isDefined():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="beacongrid-"))
        at = sc._jsc.sc().getCheckpointDir()
    return at.get().rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and losing an executor loses nothing. A result may go on reading it, so it stays."""
    return Scratch(df.sparkSession).written(df)


class Scratch:
    """Tables that only the steps of a block need: gone from the shared folder when it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}/table-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        sc = self.spark.sparkContext
        for path in map(sc._jvm.org.apache.hadoop.fs.Path, self.paths):
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def joined(rows: DataFrame, by: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """rows joined with `by`, which has one row for each key, where a key may hold any share of rows: keys of more than a HOT-th of all rows meet theirs by broadcast, all others by a shuffle."""
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    total = rows.count()
    hot = [r[: len(on)] for r in counts.where(F.col("_n") > max(1000, total // HOT)).collect()] if total > 1000 else []
    if not hot:
        return rows.join(by, on, how)
    keys = F.broadcast(rows.sparkSession.createDataFrame(hot, rows.select(*on).schema))
    few = F.broadcast(by.join(keys, on, "left_semi"))
    return rows.join(keys, on, "left_semi").join(few, on, how).unionByName(rows.join(keys, on, "left_anti").join(by, on, how))


def small(df: DataFrame) -> DataFrame:
    """A written table of ids or the like, to be broadcast if it has MOST_IDS rows at most."""
    return F.broadcast(df) if df.count() <= MOST_IDS else df


def ship(spark: SparkSession, parts: Iterator[bytes]) -> str:
    """Puts a file into the shared folder, piece by piece, from which every executor gets it; its name for SparkFiles."""
    sc, name = spark.sparkContext, f"lexicon-{uuid.uuid4().hex}.bin"
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    for part in parts:
        for i in range(0, len(part), 1 << 20):
            out.write(bytearray(part[i : i + (1 << 20)]))
    out.close()
    sc.addFile(path.toString())
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, n: int) -> Column:
    """crc32(id as text) mod n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def is_remainder(id_col: str, n: int, r: int) -> Column:
    """Whether crc32(id as text) mod n is r; false for a null id."""
    return F.coalesce(remainder(id_col, n) == F.lit(r), F.lit(False))


def typed(first: DataType, rest: str) -> StructType:
    """A column `id` of the given type, then the columns of a DDL string; names inside the type may be anything."""
    return StructType([StructField("id", first), *DataType.fromDDL(rest).fields])


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Run) -> Run:
    """run, a function over the batches of a task, after whose last batch the worker gives back what its memory pools hold, so that the next stage finds none of it."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return go


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 21):
    """Pieces of a batch of at most `most` bytes of text each (one row at least), so that array work stays small."""
    import numpy as np

    if not batch.num_rows:
        return
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype("int64")
    end = np.cumsum(size)
    at = 0
    while at < len(size):
        base = end[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(end, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def row_of(docs: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """All columns as one, for operators that only hand a row through."""
    return F.struct(F.lit(0).cast("tinyint").alias("_"), *(docs[f"`{c}`"] for c in docs.columns if c not in but))


def row_columns(docs: DataFrame, row: str, but: tuple[str, ...] = ()) -> list[Column]:
    """The columns that row_of packed."""
    return [F.col(f"{row}.`{c}`").alias(c) for c in docs.columns if c not in but]


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]
