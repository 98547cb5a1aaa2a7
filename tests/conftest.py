import os
import sys

import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, s.sparkContext.environment.get("PYTHONPATH", "")])
    yield s
    s.stop()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def oracle():
    """(sql, sf_dir) -> rows of DuckDB as a DataFrame."""
    import duckdb

    def run(sql, sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
        return con.execute(sql).df()

    return run


def rows(df):
    """Rows of a pandas frame as sorted text, floats to 6 places."""
    cols = sorted(df.columns)
    say = lambda v: "null" if v is None or v is pd.NA or v is pd.NaT or v != v else f"{float(v):.5f}" if isinstance(v, float) and v != int(v) else str(int(v)) if isinstance(v, float) else str(v)
    return cols, sorted(tuple(say(v) for v in r) for r in df[cols].astype(object).itertuples(index=False))


@pytest.fixture(scope="session")
def same():
    return lambda a, b: rows(a) == rows(b)
