import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    import siltstone

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    siltstone.ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def against():
    """Compares a query with its oracle over a scale's tables."""
    import duckdb

    def run(frame, sql, folder):
        con = duckdb.connect()
        for f in os.listdir(folder):
            con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{f}')")
        rel = con.sql(sql)
        cols = list(rel.columns)
        assert sorted(cols) == sorted(frame.columns)
        got = sorted(repr(tuple(r[c] for c in cols)) for r in frame.collect())
        assert got == sorted(map(repr, rel.fetchall()))

    return run
