"""The tables, by name, and the folder for what is written on the way."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table's rows; which columns and row groups are read is left to the plan above."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share; where that is unset and all runs in one process, as in tests, a temporary one."""
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="siltstone-work-")
    return f"{known.rstrip('/')}/{name}-{uuid.uuid4().hex}"
