"""Readers of landed files: partitioned shards, overlays, JSON, markup and feeds, configurations, reference lists.

Fetching is not the engine's: pages and payloads come as files or as rows of
(url, status, body). What a fetch's status means, and how often to try again, is.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")


def shards(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Shards under root/source=.../dt=.../, with source and dt from their paths; filters on these two skip folders."""
    return spark.read.schema(f"{schema}, source string, dt date").parquet(root)


def row_count(spark: SparkSession, paths: list[str], attempts: int = 3) -> int:
    """Rows of the files, from their footers alone; an unreadable file raises after the last attempt instead of counting as none."""
    if not paths:
        raise ValueError("no files to count")
    return retried(lambda: spark.read.option("ignoreMissingFiles", "false").parquet(*paths).count(), attempts, 0.0)


def source_of_path(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"(?:^|/)source=([^/]+)", 1), F.lit(""))


def schema_check(spark: SparkSession, path: str, contract: Iterable[str]) -> tuple[list[str], list[str]]:
    """Columns of the contract that the files lack, and columns beyond it."""
    return schema_diff(spark.read.parquet(path).columns, contract)


def schema_diff(have: Iterable[str], contract: Iterable[str]) -> tuple[list[str], list[str]]:
    have, contract = set(have), set(contract)
    return sorted(contract - have), sorted(have - contract)


def overlay_rows(spark: SparkSession, path: str, key: list[str], values: list[str]) -> DataFrame:
    """An overlay's rows that say something: those with a whole key and any value; absent columns are null."""
    rows = spark.read.parquet(path)
    columns = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in (*key, *values)]
    return rows.select(*columns).where(F.concat_ws("", *values) != "").na.drop(subset=key)


def paged(table: DataFrame, key: str, page: int) -> DataFrame:
    """table dealt out by ranges of a whole-number key, with each row's page: what paging through an ordered query reads, without the offsets."""
    return table.withColumn("page", F.floor(F.col(key) / page).cast("long")).repartitionByRange("page")


def table(spark: SparkSession, name: str, columns: list[str] | None = None, where: str = "true") -> DataFrame:
    """A catalog table's rows; the columns and the filter reach its scan."""
    out = spark.table(name).where(where)
    return out.select(*columns) if columns else out


# ---- landed responses

#: Statuses that another attempt may mend.
TRANSIENT = (429,)


def outcome(status: Column) -> Column:
    """What a fetch came to: ok, transient (no answer, 429, or the server's fault) or permanent."""
    return F.when(status.isNull() | status.isin(*TRANSIENT) | (status >= 500), "transient").when(status.between(200, 299), "ok").otherwise("permanent")


def json_rows(responses: DataFrame, body: str, schema: str, status: str = "status") -> DataFrame:
    """The responses that came through, their body parsed; what is no JSON of the schema is null."""
    return responses.where(outcome(F.col(status)) == "ok").withColumn(body, F.from_json(body, schema))


# What a page says that asks for proof of a reader, or that it failed.
CHALLENGES = ("just a moment", "attention required", "pardon our interruption", "access denied", "captcha", "verify you are human")


def rendered_state(title: Column, body: Column) -> Column:
    """Of a rendered page: challenge, empty or ok."""
    asked = F.lower(F.concat_ws(" ", title, F.substring(body, 1, 2000)))
    wall = F.exists(F.array(*map(F.lit, CHALLENGES)), lambda c: asked.contains(c))
    return F.when(wall, "challenge").when(F.length(F.trim(F.coalesce(body, F.lit("")))) == 0, "empty").otherwise("ok")


def feed_items(xml: Column, fields: Iterable[str]) -> Column:
    """The items of an RSS feed as an array of structs of texts."""
    names = list(fields)
    columns = [F.xpath(xml, F.lit(f"//item/{f}/text()")) for f in names]
    return F.arrays_zip(*[c.alias(f) for c, f in zip(columns, names, strict=True)])


def sitemap_urls(xml: Column) -> Column:
    return F.xpath(xml, F.lit("//*[local-name()='loc']/text()"))


# ---- attempts


def delays(attempts: int, least: float, most: float, jitter: float = 0.0, rng: random.Random | None = None) -> Iterator[float]:
    """Seconds before each attempt but the first: doubled from `least` to `most` at most, each drawn out by up to `jitter` of itself."""
    rng = rng or random.Random()
    for k in range(attempts - 1):
        yield min(most, least * 2**k) * (1 + jitter * rng.random())


class Permanent(Exception):
    """What no further attempt would mend."""


def retried(call: Callable[[], T], attempts: int = 3, least: float = 1.0, most: float = 90.0, jitter: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """call's value, tried again after every exception but Permanent; the last one is raised. For the driver's own steps: tasks are retried by the cluster."""
    waits = delays(attempts, least, most, jitter)
    while True:
        try:
            return call()
        except Permanent:
            raise
        except Exception:
            wait = next(waits, None)
            if wait is None:
                raise
            sleep(wait)


# ---- reference data


def seed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A list of reference rows as a table."""
    return spark.createDataFrame(rows, schema)


SITE_CONFIG = "source_code string, base_url string, listing_path string, selectors map<string,string>, listing_json_path string, listing_json_url_template string, detail_label_map map<string,string>, detail_json_map map<string,string>, min_description_chars int"


def site_configs(spark: SparkSession, path: str) -> DataFrame:
    """One row for each JSON file of a site's configuration; keys beyond SITE_CONFIG are left out, absent ones null."""
    return spark.read.schema(SITE_CONFIG).option("multiLine", True).json(path)


def mapped(records: DataFrame, body: str, source: str, mapping: DataFrame) -> DataFrame:
    """(key columns of records), field and value: each record's values at the JSON paths that its source's rows of mapping (source, field, path) name. One table of mappings stands for a reader per source."""
    rest = [c for c in records.columns if c != body]
    by_source = mapping.groupBy(source).agg(F.sort_array(F.collect_list(F.struct("field", "path"))).alias("fields"))
    met = records.join(by_source, source).select(*rest, body, F.explode("fields").alias("f"))
    # a path is data here: get_json_object takes one that differs from row to row
    return met.select(*rest, F.col("f.field").alias("field"), F.expr(f"get_json_object({body}, concat('$.', f.path))").alias("value"))
