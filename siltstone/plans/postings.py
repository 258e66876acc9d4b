"""Queries of the posting functions, places, merges and queues, with their oracle statements.

The driver's tables hold no postings, so titles, descriptions and amounts are
taken from the lists below by a row's key, the same in the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import postings as p
from siltstone.operators import merges
from siltstone.sources.tables import read

TITLES = ("Chief Executive Officer", "Senior DevOps Engineer (Linux, PHP)", "Team Lead [urgent]", "Junior Analyst - remote", "Intern", "test 12", "Data Engineer", "Staff Engineer (m/w/d) - Full-time", "", "Sr. C++ / Go Developer, hybrid", "Mid-level R&D Chemist")
TEXTS = (
    "PhD or master's degree, 5 years of experience; visa sponsorship available.", "Bachelor's degree in physics. 3 to 5 years experience. Hybrid.", "Remote, worldwide. No visa sponsorship, and no relocation.",
    "On-site. Relocation package. High school diploma.", "We cannot relocate you. 12+ years of experience, telework", "short", "Aucun diplome: no degree needed for an entry-level role in an office",
)
PERIODS = ("Annual", " per hour ", "month", "yearly", "fortnight", "DAY", "")
AMOUNTS = ("12,345.67", "12.345,67", "21,000", "16261,86", "15 EUR", "", "0", "1.234.567", "n/a", "30000")
TERMS = ("R", "Go", "C", "Python", "JavaScript", "Java", "Machine Learning")
SKILLS = (("R and Go developers", "Go|R"), ("R&D manager, go getter", ""), ("python, JAVASCRIPT and java", "Java|JavaScript|Python"), ("Golang or C-level", ""), ("machine learning in Python3", "Machine Learning"), ("C, R/Go", "C"))

YEARS = (("3-5 years", 3, 5), ("at least 4 years of experience", 4, None), ("7+ yrs", 7, None), ("9 to 2 years, or 6+ years", 6, None), ("40+ years", None, None), ("a team of 12", None, None), ("", None, None), ("2 bis 4 Jahre Erfahrung", 2, 4))
ROLES = (
    ("Chief Data Officer", "", "executive", True), ("Head of Sales", "", "director", True), ("Store manager", "", "manager", True), ("Tech Lead", "You will manage a team", "team_lead", True), ("Tech Lead", "", "team_lead", None),
    ("Junior Analyst", "direct reports", "individual_contributor", False), ("Nurse", "supervise staff daily", "manager", True), ("Nurse", "", None, None), ("", "direct reports", None, None),
)


def _of(items: tuple[str, ...], key: str) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), (F.col(key) % len(items) + 1).cast("int"))


def _column(rows: tuple[tuple, ...], k: int) -> tuple:
    return tuple(r[k] for r in rows)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))


def _function(name: str, build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _orders(spark, sf_dir).select("o_orderkey", *build())

    run.__name__ = name
    return run


def title() -> Column:
    return _of(TITLES, "o_orderkey")


def text() -> Column:
    return _of(TEXTS, "o_orderkey")


FUNCTIONS = {
    "flt_non_job": lambda: [p.is_non_job(title(), text()).alias("non_job")],
    "fn_experience_years": lambda: [c.alias(n) for c, n in zip(p.experience_range(_of(_column(YEARS, 0), "o_orderkey")), ("years_min", "years_max"), strict=True)],
    "fn_seniority": lambda: [c.alias(n) for c, n in zip(p.seniority(_of(_column(ROLES, 0), "o_orderkey"), _of(_column(ROLES, 1), "o_orderkey")), ("role", "managerial"), strict=True)],
    "fn_pay_period": lambda: [p.pay_period(_of(PERIODS, "o_orderkey")).alias("period")],
    "fn_salary_eu_amount": lambda: [p.european_amount(_of(AMOUNTS, "o_orderkey")).alias("amount")],
    "fn_skill_scan": lambda: [F.array_join(p.skill_scan(_of(tuple(t for t, _ in SKILLS), "o_orderkey"), TERMS), "|").alias("skills")],
}


def mrg_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("k"), "day", F.col("day").alias("seen"))
    shard = o.where("k % 2 = 0").select("k", F.when(F.col("k") % 10 != 0, F.col("day")).alias("day"), F.date_add("seen", 7).alias("seen"))
    return merges.merge_shard(o.where("k % 3 <> 0"), shard, "k", "day", "seen")


def mrg_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "customer")
    return merges.get_or_create(s.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), c.select(F.col("c_name").alias("name")), "k", "name")


def str_claim_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    queue = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "done").otherwise("failed").alias("status"), F.when(F.col("o_orderkey") % 11 != 0, F.col("day")).alias("last"))
    return merges.claim(queue, "o_orderkey", "status", "last", 50)


def sink_prune_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").where("source IS NOT NULL")
    d = d.select("doc_id", "source", F.concat(F.lit("shards/source="), "source", F.lit("/part-"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 5 == 0, ".tmp").otherwise(".parquet")).alias("path"))
    return merges.deletable(d.select("path", "source"), d.where("doc_id % 2 = 0 AND source <> 'src0'"), d.where("doc_id % 7 = 0"), "path", "source")


FRAMES = {f.__name__: f for f in (mrg_shard, mrg_get_or_create, str_claim_queue, sink_prune_guard)}


def queries() -> dict:
    return {k: _function(k, f) for k, f in FUNCTIONS.items()} | FRAMES


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _value(items, kind: str) -> str:
    """The item of a row's key as SQL; None is null."""
    shown = ["NULL" if x is None else _quoted(x) if isinstance(x, str) else str(x) for x in items]
    return f"([{', '.join(shown)}][o_orderkey % {len(items)} + 1])::{kind}"


def _item(items, key: str = "o_orderkey") -> str:
    return f"[{', '.join(map(_quoted, items))}][{key} % {len(items)} + 1]"


def oracle_sql() -> dict[str, str]:
    t = f"(SELECT o_orderkey, {_item(TITLES)} AS t, {_item(TEXTS)} AS x FROM orders)"
    return {
        "flt_non_job": f"SELECT o_orderkey, t = 'test 12' OR length(x) < 15 AS non_job FROM {t}",
        "fn_experience_years": f"SELECT o_orderkey, {_value(_column(YEARS, 1), 'INTEGER')} AS years_min, {_value(_column(YEARS, 2), 'INTEGER')} AS years_max FROM orders",
        "fn_seniority": f"SELECT o_orderkey, {_value(_column(ROLES, 2), 'VARCHAR')} AS role, {_value(_column(ROLES, 3), 'BOOLEAN')} AS managerial FROM orders",
        "fn_pay_period": "SELECT o_orderkey, ['yearly', 'hourly', 'monthly', 'yearly', NULL, 'daily', NULL][o_orderkey % 7 + 1] AS period FROM orders",
        "fn_salary_eu_amount": "SELECT o_orderkey, [12345.67, 12345.67, 21000, 16261.86, 15, NULL, NULL, 1234567, NULL, 30000][o_orderkey % 10 + 1]::DOUBLE AS amount FROM orders",
        "fn_skill_scan": f"SELECT o_orderkey, {_item([s for _, s in SKILLS])} AS skills FROM orders",
        "mrg_shard": """WITH a AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day FROM orders)
            SELECT k, day, CASE WHEN change = 'kept' THEN day ELSE (day + 7)::DATE END AS seen, change FROM (SELECT *, CASE WHEN k % 2 <> 0 OR k % 10 = 0 THEN CASE WHEN k % 3 <> 0 THEN 'kept' END WHEN k % 3 = 0 THEN 'inserted' ELSE 'touched' END AS change FROM a) WHERE change IS NOT NULL""",
        "mrg_get_or_create": """SELECT s_suppkey AS k, s_name AS name FROM supplier UNION ALL SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY substr(md5(name), 1, 2), name), name
            FROM (SELECT DISTINCT c_name AS name FROM customer WHERE c_name IS NOT NULL AND c_name NOT IN (SELECT s_name FROM supplier))""",
        "str_claim_queue": """WITH q AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'done' ELSE 'failed' END AS status, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE END AS last FROM orders)
            SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM q WHERE status <> 'failed' ORDER BY last NULLS FIRST, o_orderkey LIMIT 50) THEN 'in_progress' ELSE status END AS status, last FROM q""",
        "sink_prune_guard": """SELECT source, 'shards/source=' || source || '/part-' || doc_id || '.parquet' AS path FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND source IN (SELECT source FROM documents WHERE doc_id % 2 = 0 AND source <> 'src0')""",
    }
