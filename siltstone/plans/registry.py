"""All queries of the relational operators, by name, and their oracle statements."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import entity
from siltstone.sources.tables import TABLES, read
from siltstone.streaming import incremental

from . import extraction, postings, storage, wide
from .shared import SHARED, SPLIT


def statement(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query that binds the statement's tables and runs it."""
    names = [t for t in TABLES if "{" + t + "}" in sql]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(sql, **{t: read(spark, sf_dir, t) for t in names})

    return run


def _oracle(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def join_self_theta_trgm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity.trigram_pairs(read(spark, sf_dir, "part"), "p_partkey", "p_name").select("a", "b", F.round("similarity", 4).alias("similarity"))


def fn_strip_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    name = F.concat("c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, F.lit(" Group Ltd.")).when(F.col("c_custkey") % 3 == 1, F.lit(" Inc")).otherwise(F.lit("")))
    return c.select("c_custkey", entity.without_suffix(name).alias("stripped"))


DATAFRAME = {f.__name__: f for f in (join_self_theta_trgm, fn_strip_suffix)} | {"str_ledger_exactly_once": incremental.ledger_merge, "str_watermark_export": incremental.watermark_export}

_GRAMS = """SELECT n, list_distinct(flatten(list_transform(list_filter(string_split_regex(lower(n), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''),
    lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substr('  ' || w || ' ', i, 3))))) AS g FROM (SELECT DISTINCT p_name AS n FROM part WHERE p_name IS NOT NULL)"""
DATAFRAME_ORACLE = {
    "join_self_theta_trgm": f"""WITH s AS ({_GRAMS}), f AS (SELECT p_name AS n, min(p_partkey) AS k FROM part GROUP BY 1), p AS (SELECT a.n AS n1, b.n AS n2, len(list_intersect(a.g, b.g)) AS k, len(a.g) + len(b.g) AS t FROM s a JOIN s b ON a.n < b.n WHERE len(a.g) > 0 AND len(b.g) > 0)
        SELECT least(x.k, y.k) AS a, greatest(x.k, y.k) AS b, round(p.k::DOUBLE / (t - p.k), 4) AS similarity FROM p JOIN f x ON x.n = n1 JOIN f y ON y.n = n2 WHERE p.k::DOUBLE / (t - p.k) >= 0.5
        UNION ALL SELECT f.k, q.p_partkey, 1.0 FROM part q JOIN f ON f.n = q.p_name JOIN s ON s.n = f.n WHERE q.p_partkey <> f.k AND len(s.g) > 0""",
    "fn_strip_suffix": "SELECT c_custkey, c_mktsegment AS stripped FROM customer",
    "str_ledger_exactly_once": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "str_watermark_export": "SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-03 00:00:00'",
}


#: Reports and scans that are other queries under a name of their own.
SAME_AS = {
    "src_parquet_projection": "src_projection", "q_active_jobs": "join_active_view", "q_completeness": "agg_completeness", "q_source_status": "agg_group_count", "q_title_status": "agg_match_method", "q_families": "topk_families",
    "q_companies": "topk_companies", "q_skills": "topk_skills", "q_dashboard": "q_dashboard_kpis", "q_explore": "q_explore_counts",
}


def _named(found: dict) -> dict:
    return found | {name: found[other] for name, other in SAME_AS.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    statements = {k: statement(v) for k, v in (SHARED | {k: v[0] for k, v in SPLIT.items()} | wide.SHARED).items()}
    return _named(statements | DATAFRAME | postings.queries() | extraction.queries() | storage.queries() | wide.queries())


def oracle_sql() -> dict[str, str]:
    statements = {k: _oracle(v) for k, v in (SHARED | wide.SHARED).items()} | {k: v[1] for k, v in SPLIT.items()}
    return _named(statements | DATAFRAME_ORACLE | postings.oracle_sql() | extraction.oracle_sql() | storage.oracle_sql() | wide.oracle_sql())
