"""From raw documents to token ids, in five stages that each keep their result as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import siltstone
from siltstone.llm import bpe, line_dedup, mixing, quality_classifier, simhash
from siltstone.llm.common import new_path, read, release, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    siltstone.ship(spark)
    docs = docs.select(*COLUMNS)
    model = quality_classifier.learn(docs, read(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).where(F.col("score") >= quality_classifier.THRESHOLD).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text."""
    siltstone.ship(spark)
    out = line_dedup.line_dedup(docs.select(*COLUMNS))
    return out.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    siltstone.ship(spark)
    return simhash.near_dedup(docs.select(*COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights: a row for each pass over a document."""
    siltstone.ship(spark)
    return mixing.mix(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of the bytes that they decode to."""
    siltstone.ship(spark)
    return bpe.encode(docs.select("doc_id", "text", "lang", "source"))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("mixing", mixture), ("byte-level BPE", tokens)]

#: SQL cannot express the classifier, the permutations or the merges; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents, each written and read again; what a stage wrote on its way goes once its result is written."""
    out, before = read(spark, sf_dir, "documents"), written(spark)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, out, sf_dir)
        if k + 1 < len(STAGES):
            path = new_path(spark, f"pipeline-{k}")
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
            release(spark, before | {path})
    return out
