"""Writers: shards newer than a watermark, whole snapshots, state, change logs and reports."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_state(spark: SparkSession, path: str) -> dict:
    """A JSON state document; an absent one is empty."""
    fs, p = _fs(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if fs.exists(p) else {}


def write_state(spark: SparkSession, path: str, state: dict) -> None:
    """Replace the state document: written beside the old one, then moved over it."""
    new, old = f"{path}.new", f"{path}.old"
    spark.range(1).select(F.lit(json.dumps(state, sort_keys=True)).alias("value")).coalesce(1).write.mode("overwrite").text(new)
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(_fs(spark, old)[1], True)
        fs.rename(p, _fs(spark, old)[1])
    fs.rename(_fs(spark, new)[1], p)


def export_newer(rows: DataFrame, root: str, state_path: str, source: str, at: str, stamp: str) -> dict[str, int]:
    """Write each source's rows newer than its high-water mark as one more set of files, then move the marks; the rows written, by source.

    A source that is not in the state is written whole. Files are never
    rewritten; a run that stops before its state is written repeats its rows
    under a new stamp, and readers take the latest of a key.
    """
    spark = rows.sparkSession
    state = read_state(spark, state_path)
    marks = spark.createDataFrame([(s, m) for s, m in sorted(state.items())], "__s string, __mark string")  # a row for each source
    fresh = rows.join(F.broadcast(marks), F.col(source) == F.col("__s"), "left").where(F.col("__mark").isNull() | (F.col(at).cast("string") > F.col("__mark"))).drop("__s", "__mark")
    path = f"{root}/stamp={stamp}"
    fresh.write.partitionBy(source).option("compression", "zstd").parquet(path)
    wrote = {r[source]: (r["n"], r["top"]) for r in spark.read.schema(fresh.schema).parquet(path).groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.max(F.col(at).cast("string")).alias("top")).collect()}
    write_state(spark, state_path, state | {s: top for s, (_, top) in wrote.items()})
    return {s: n for s, (n, _) in wrote.items()}


def snapshot(rows: DataFrame, root: str, source: str) -> None:
    """Replace the files of the sources that rows hold; other sources' files stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).option("compression", "snappy").parquet(root)


def dump(tables: dict[str, DataFrame], root: str, leave_out: Iterable[str] = ()) -> list[str]:
    """Write each table but those left out under its name; the names written."""
    names = sorted(set(tables) - set(leave_out))
    for name in names:
        tables[name].write.mode("overwrite").parquet(f"{root}/{name}")
    return names


def load_order(references: dict[str, set[str]]) -> list[str]:
    """Tables so that each comes after those it refers to, by name where free; a circle raises."""
    left, out = {t: r - {t} for t, r in references.items()}, []
    while left:
        free = sorted(t for t, r in left.items() if not r & left.keys())
        if not free:
            raise ValueError(f"tables refer to each other in a circle: {sorted(left)}")
        out += free
        left = {t: r for t, r in left.items() if t not in free}
    return out


def restore(spark: SparkSession, root: str, references: dict[str, set[str]], key: dict[str, str]) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The dumped tables in load_order(), and the next free id of each table with a key."""
    out = {name: spark.read.parquet(f"{root}/{name}") for name in load_order(references)}
    return out, {t: (out[t].agg(F.max(k)).first()[0] or 0) + 1 for t, k in key.items()}


def audit(before: DataFrame, after: DataFrame, key: str, table: str, columns: list[str]) -> DataFrame:
    """A log row for each key whose columns differ, came or went: table_name, record_id, operation, old_data and new_data as JSON."""
    b, a = before.select(key, F.struct(*columns).alias("was")), after.select(key, F.struct(*columns).alias("now"))
    both = b.join(a, key, "full_outer").where(~F.col("was").eqNullSafe(F.col("now")))
    kind = F.when(F.col("was").isNull(), "insert").when(F.col("now").isNull(), "delete").otherwise("update")
    return both.select(F.lit(table).alias("table_name"), F.col(key).alias("record_id"), kind.alias("operation"), F.to_json("was").alias("old_data"), F.to_json("now").alias("new_data"))


def staged(rows: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """What copying rows to a stage and joining from it gives: target's rows that the stage names, with the last row of a repeated key."""
    order = [F.desc(c) for c in rows.columns if c not in key]
    last = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n") if order else rows.distinct()
    return target.join(last, key)


def markdown(title: str, parts: dict[str, DataFrame], most: int = 50) -> str:
    """A report of small aggregates: a heading and a table of at most `most` rows for each part."""
    out = [f"# {title}"]
    for name, rows in parts.items():
        out += ["", f"## {name}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.limit(most).collect()]
    return "\n".join(out) + "\n"
