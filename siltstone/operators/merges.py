"""Merges, queues and guards as pure functions from tables to tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_shard(old: DataFrame, shard: DataFrame, key: str, day: str, seen: str) -> DataFrame:
    """Every key's row with `change`: kept, touched or inserted.

    A shard's row without a day is skipped. A known key only moves `seen` on;
    an unknown one comes in, of repeated ones the earliest by day, then seen.
    """
    fresh = shard.where(F.col(day).isNotNull())
    first = fresh.groupBy(key).agg(F.min(F.struct(F.col(day).alias("d"), F.col(seen).alias("s"))).alias("r"), F.max(seen).alias("latest"))
    both = old.join(first.withColumnRenamed(key, "__key"), F.col(key) == F.col("__key"), "full_outer")
    change = F.when(F.col("__key").isNull(), "kept").when(F.col(key).isNull(), "inserted").otherwise("touched")
    return both.select(F.coalesce(key, "__key").alias(key), F.when(change == "inserted", F.col("r.d")).otherwise(F.col(day)).alias(day), F.greatest(F.col(seen), F.when(change == "inserted", F.col("r.s")).otherwise(F.col("latest"))).alias(seen), change.alias("change"))


def get_or_create(known: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """known (key, name) with every further name of names, numbered on from the greatest key.

    New names are numbered by (first byte of their MD5, name): pieces are
    counted with map-side combining, one row for each of 256 pieces is summed
    up, and only within a piece names are put in order. Null names are skipped.
    """
    new = names.where(F.col(name).isNotNull()).select(name).distinct().join(known.select(name), name, "left_anti").withColumn("__p", F.substr(F.md5(F.col(name).cast("binary")), F.lit(1), F.lit(2)))
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    return known.select(F.col(key).cast("long").alias(key), name).unionByName(_numbered(new, "__p", name).select((top + F.col("i")).alias(key), name))


def numbered(rows: DataFrame, key: str, span: int = 1 << 16) -> DataFrame:
    """rows with `i`, from 1 in order of the key, a whole number: counted by spans of keys, put in order within a span only."""
    return _numbered(rows.withColumn("__p", F.floor(F.col(key) / span)), "__p", key).drop("__p")


def _numbered(rows: DataFrame, piece: str, order: str) -> DataFrame:
    sums = rows.groupBy(piece).agg(F.count(F.lit(1)).alias("n"))
    base = sums.select(piece, (F.sum("n").over(Window.orderBy(piece)) - F.col("n")).alias("base"))  # a row for each piece
    return rows.withColumn("i", F.row_number().over(Window.partitionBy(piece).orderBy(order))).join(base, piece).withColumn("i", F.col("base") + F.col("i")).drop("base")


def claim(queue: DataFrame, key: str, status: str, last: str, limit: int) -> DataFrame:
    """queue after `limit` pending or done rows, those due longest first, became in_progress; never done ones come first."""
    due = queue.where(F.col(status).isin("pending", "done")).orderBy(F.col(last).asc_nulls_first(), key).limit(limit).select(F.col(key).alias("__key"), F.lit(True).alias("__mine"))
    return queue.join(due, F.col(key) == F.col("__key"), "left").withColumn(status, F.when(F.col("__mine"), "in_progress").otherwise(F.col(status))).drop("__key", "__mine")


def seed_queue(queue: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """queue (key, status, last, errors, note) with every source that it lacks, pending."""
    new = sources.select(key).distinct().join(queue.select(key), key, "left_anti")
    return queue.unionByName(new.select(key, F.lit("pending").alias("status"), F.lit(None).cast("date").alias("last"), F.lit(0).alias("errors"), F.lit(None).cast("string").alias("note")))


def settle(queue: DataFrame, results: DataFrame, key: str, day: Column) -> DataFrame:
    """queue after results (key, note) of rows in progress: done without a note, else failed, with one error more; others stay as they are."""
    met = queue.join(results.select(key, F.col("note").alias("__note"), F.lit(True).alias("__told")), key, "left")
    told = F.coalesce("__told", F.lit(False)) & (F.col("status") == "in_progress")
    failed = told & F.col("__note").isNotNull()
    return met.select(key, F.when(failed, "failed").when(told, "done").otherwise(F.col("status")).alias("status"), F.when(told, day).otherwise(F.col("last")).alias("last"), (F.col("errors") + failed.cast("int")).alias("errors"), F.when(told, F.col("__note")).otherwise(F.col("note")).alias("note"))


def insert_missing(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """old with new's rows of keys that it lacks, of a repeated key the least; rows that are there are never replaced, and rows of nulls alone not inserted."""
    fresh = new.na.drop("all", subset=columns).groupBy(key).agg(F.min(F.struct(*columns)).alias("r")).select(key, "r.*")
    return old.select(key, *columns).unionByName(fresh.join(old.select(key), key, "left_anti"))


def deletable(existing: DataFrame, written: DataFrame, uploaded: DataFrame, path: str, source: str) -> DataFrame:
    """Rows of existing that a rewrite replaces: Parquet, of a source written this time, not just uploaded; none if nothing was written."""
    shards = existing.where(F.col(path).endswith(".parquet") & F.col(path).startswith("shards/"))
    return shards.join(written.select(source).distinct(), source, "left_semi").join(uploaded.select(path), path, "left_anti")


def classify_titles(jobs: DataFrame, taxonomy: DataFrame, title: str, core: str, non_job: str, vector: str, least: float) -> DataFrame:
    """jobs with title_id, confidence and status: excluded_non_job, matched or no_match.

    The cleaned title by its name counts 1.00, its core 0.95, the taxonomy's
    smallest id of equal names; else the entry of the nearest vector by cosine
    counts its cosine, and matches from `least` on, of equal ones the smallest
    id. Vectors are compared once for each different title without a name. The
    taxonomy is a reference list: at most 10,000 entries, or ValueError.
    """
    from .entity import bounded_rows

    names = taxonomy.groupBy(F.lower("name").alias("__name")).agg(F.min("id").alias("__id"))
    a, b = names.alias("a"), names.alias("b")
    both = jobs.join(a, F.lower(title) == F.col("a.__name"), "left").join(b, F.lower(core) == F.col("b.__name"), "left")
    named = both.select(*[jobs[c] for c in jobs.columns], F.coalesce("a.__id", "b.__id").alias("__named"), F.when(F.col("a.__id").isNotNull(), 1.0).when(F.col("b.__id").isNotNull(), 0.95).alias("__sure"))
    entries = bounded_rows(taxonomy.select("id", vector), 10_000)
    own = named.where(F.col("__named").isNull() & ~F.col(non_job)).groupBy(title).agg(F.first(vector).alias("v"))
    ids = np.array([r["id"] for r in entries], dtype=np.int64)
    matrix = np.array([r[vector] for r in entries], dtype=float).reshape(len(ids), -1)
    matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)

    def nearest(batches):
        for pdf in batches:
            v = np.array(pdf["v"].tolist(), dtype=float).reshape(len(pdf), -1)
            s = np.round(v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300) @ matrix.T, 6)
            k = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, 0]
            yield pd.DataFrame({"__title": pdf[title], "__near": ids[k], "__cosine": s[np.arange(len(k)), k]})

    schema = "__title string, __near long, __cosine double"
    near = own.mapInPandas(nearest, schema) if len(ids) else jobs.sparkSession.createDataFrame([], schema)
    out = named.join(near, F.col(title) == F.col("__title"), "left")
    close = F.col("__cosine") >= least
    found = F.coalesce("__named", F.when(close, F.col("__near")))
    status = F.when(F.col(non_job), "excluded_non_job").when(found.isNotNull(), "matched").otherwise("no_match")
    return out.select(*jobs.columns, F.when(~F.col(non_job), found).alias("title_id"), F.when(~F.col(non_job), F.coalesce("__sure", "__cosine")).alias("confidence"), status.alias("status"))
