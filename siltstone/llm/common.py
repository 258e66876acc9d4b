"""Helpers the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a regular-expression class body.
WS = r"\x20\x09-\x0D"
WORD = rf"[^{WS}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; where it is unset and all runs in one process, as in tests, one of our own."""
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="siltstone-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


_paths: dict[str, list[str]] = {}


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/siltstone/{name}-{uuid.uuid4().hex}"
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(spark: SparkSession) -> set[str]:
    """The intermediate tables that this application has written and not deleted."""
    return set(_paths.get(spark.sparkContext.applicationId, ()))


def release(spark: SparkSession, keep: set[str] = frozenset()) -> None:
    """Delete the intermediate tables that this application has written, but for those to keep: for when the results that rest on them are written themselves."""
    app = spark.sparkContext.applicationId
    for path in _paths.pop(app, []):
        if path in keep:
            _paths.setdefault(app, []).append(path)
        else:
            remove(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again: lineage ends there, and no executor holds the only copy."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that materialize() or new_path() named."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, use) -> Column:
    """use(value), with value evaluated once for a row, however often use() names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def shuffles(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, share: float) -> DataFrame:
    """rows joined with table on keys, of which table holds each once with `weight`, its number of rows.

    Keys with more rows than `share`, a task's mean, are fewer than the tasks:
    these few are broadcast, so that no key's rows meet in one task. All others
    meet by key.
    """
    hot, rest = F.broadcast(table.where(F.col(weight) > share).drop(weight)), table.where(F.col(weight) <= share).drop(weight)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys))
