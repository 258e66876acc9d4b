"""Wide projections, completeness, page quality, pay, days, duplicates and places: queries with their oracle statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import markup, postings, salary, text
from siltstone.operators import entity, merges, places, quality, store
from siltstone.sources import files as sources
from siltstone.sources.tables import read

from .extraction import TEXT, Cases, _pick, _script_of

#: The 56 columns of a posting shard, drawn from the tables: a line as a posting, its order, customer, part and supplier as
#: its dimensions, the order's document as its description, and the customer's latest event as its pay.
_SHARD = """SELECT CAST(l.l_orderkey AS {text}) AS source_job_id, s.s_name AS source_code, upper(s.s_name) AS source_name, c.c_name AS company_name, CAST(o.o_orderdate AS DATE) AS posting_date, CAST(l.l_shipdate AS DATE) AS closing_date,
    o.o_orderdate AS first_scraped_at, p.p_name AS title_original, CASE WHEN l.l_linenumber % 2 = 0 THEN upper(p.p_name) END AS title_en, d.lang AS language_code, CAST(p.p_partkey AS {text}) AS normalized_title_id, o.o_orderstatus AS job_status,
    CAST(l.l_quantity AS INTEGER) AS num_vacancies, b.quality = 1 AS visa_sponsorship, b.toxic = 1 AS relocation_support, CASE WHEN g.url LIKE 'mailto:%' THEN 'email' ELSE 'external_url' END AS application_method, g.url AS application_url, g.url AS job_url,
    concat(l.l_returnflag, l.l_linestatus) AS content_hash, CASE WHEN l.l_linenumber > 1 THEN CAST(l.l_orderkey AS {text}) END AS is_duplicate_of, l.l_discount AS data_quality_score, concat(n.n_name, ', ', r.r_name) AS location_raw, n.n_nationkey IS NULL AS is_global_remote,
    p.p_type AS remote_work_type, n.n_name AS city_name, substr(r.r_name, 1, 2) AS country_code, r.r_name AS country_name, o.o_orderpriority AS employment_type, c.c_mktsegment AS experience_level, p.p_size AS experience_years_min, p.p_size + l.l_linenumber AS experience_years_max,
    p.p_brand AS seniority_role_type, p.p_size > 25 AS is_managerial, sn.n_name AS work_schedule, sr.r_name AS education_level, lower(p.p_brand) AS education_field_raw, lower(p.p_type) AS education_field_normalized, concat(p.p_type, ',', p.p_brand) AS skills_normalized,
    l.l_linestatus AS benefits_normalized, d.source AS job_category, l.l_extendedprice AS salary_min, l.l_extendedprice + l.l_quantity AS salary_max, CASE WHEN e.value > 50 THEN 'USD' ELSE 'GBP' END AS salary_currency, e.event_type AS pay_period,
    e.value AS salary_annual_min_usd, e.value * 2 AS salary_annual_max_usd, e.value IS NOT NULL AS salary_disclosed, e.value < 10 AS is_negotiable, d.text AS description_clean, k.text AS description_en, coalesce(k.text, d.text) AS text_en, substr(d.text, 1, 20) AS requirements,
    substr(d.text, 21, 20) AS responsibilities, substr(k.text, 1, 10) AS required_skills_text, substr(k.text, 11, 10) AS preferred_skills_text, d.n_chars AS word_count
    FROM {{lineitem}} l JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey LEFT JOIN {{customer}} c ON c.c_custkey = o.o_custkey LEFT JOIN {{documents}} d ON d.doc_id = o.o_orderkey LEFT JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey LEFT JOIN {{region}} r ON r.r_regionkey = n.n_regionkey
    LEFT JOIN {{part}} p ON p.p_partkey = l.l_partkey LEFT JOIN {{supplier}} s ON s.s_suppkey = l.l_suppkey LEFT JOIN {{nation}} sn ON sn.n_nationkey = s.s_nationkey LEFT JOIN {{region}} sr ON sr.r_regionkey = sn.n_regionkey LEFT JOIN {{labels}} b ON b.doc_id = d.doc_id
    LEFT JOIN {{pages}} g ON g.page_id = d.doc_id LEFT JOIN {{benchmark}} k ON k.item_id = d.doc_id
    LEFT JOIN (SELECT user_id, event_type, value FROM (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM {{events}}) x WHERE rn = 1) e ON e.user_id = c.c_custkey"""

#: The 22 columns of a posting's facts.
_FACTS = """SELECT o.o_orderkey AS job_id, c.c_name AS company_name, n.n_name AS city_name, r.r_name AS country_name, o.o_orderstatus AS job_status, o.o_orderpriority AS employment_type, c.c_mktsegment AS experience_level, CAST(o.o_orderdate AS DATE) AS posting_date, x.last_ship AS closing_date,
    CAST(year(o.o_orderdate) AS INTEGER) AS posting_year, CAST(month(o.o_orderdate) AS INTEGER) AS posting_month, o.o_totalprice AS salary, d.lang AS language_code, d.n_chars AS word_count, d.source AS source_code, b.quality AS quality_label, b.toxic AS toxic_label,
    coalesce(x.n, 0) AS skill_count, coalesce(x.n_parts, 0) AS part_count, coalesce(x.quantity, 0) AS vacancies, d.doc_id IS NOT NULL AS has_description, o.o_totalprice > 100000 AS is_high
    FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey LEFT JOIN {region} r ON r.r_regionkey = n.n_regionkey LEFT JOIN {documents} d ON d.doc_id = o.o_orderkey LEFT JOIN {labels} b ON b.doc_id = o.o_orderkey
    LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS n_parts, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, max(CAST(l_shipdate AS DATE)) AS last_ship FROM {lineitem} GROUP BY l_orderkey) x ON x.l_orderkey = o.o_orderkey"""

SHARED: dict[str, str] = {
    "src_projection": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM {orders}",
    "flt_not_distinct": """SELECT c.c_custkey, k.name FROM (SELECT c_custkey, CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END AS n FROM {customer}) c JOIN (SELECT n_nationkey AS n, n_name AS name FROM {nation} UNION ALL SELECT NULL, 'none') k ON k.n IS NOT DISTINCT FROM c.n""",
    "join_new_first": "SELECT o.o_orderkey, l.l_orderkey IS NOT NULL AS is_known FROM {orders} o LEFT JOIN (SELECT DISTINCT l_orderkey FROM {lineitem} WHERE l_orderkey % 7 <> 0) l ON l.l_orderkey = o.o_orderkey ORDER BY l.l_orderkey IS NOT NULL, o.o_orderkey DESC LIMIT 300",
    "sort_nulls": "SELECT l_orderkey, l_linenumber, d FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS d FROM {lineitem} WHERE l_orderkey < 300) x ORDER BY d DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 400",
    "proj_shard_select": _SHARD.format(text="VARCHAR(20)"),
    "join_job_facts": _FACTS,
    "join_star_left": """SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus, c.c_name, cn.n_name AS company_city, cr.r_name AS company_country, p.p_brand, s.s_name, sn.n_name AS supplier_city, sr.r_name AS supplier_country, d.lang, b.quality, g.url, k.text AS passage, e.label AS vector_label
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey LEFT JOIN {customer} c ON c.c_custkey = o.o_custkey LEFT JOIN {nation} cn ON cn.n_nationkey = c.c_nationkey LEFT JOIN {region} cr ON cr.r_regionkey = cn.n_regionkey LEFT JOIN {part} p ON p.p_partkey = l.l_partkey
        LEFT JOIN {supplier} s ON s.s_suppkey = l.l_suppkey LEFT JOIN {nation} sn ON sn.n_nationkey = s.s_nationkey LEFT JOIN {region} sr ON sr.r_regionkey = sn.n_regionkey LEFT JOIN {documents} d ON d.doc_id = l.l_orderkey LEFT JOIN {labels} b ON b.doc_id = l.l_orderkey
        LEFT JOIN {pages} g ON g.page_id = l.l_orderkey LEFT JOIN {benchmark} k ON k.item_id = l.l_orderkey LEFT JOIN {embeddings} e ON e.vec_id = l.l_orderkey""",
    "join_pending_antijoin": """SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source, n_chars ORDER BY length(text) DESC, doc_id) AS rn FROM {documents}) x
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {labels} b WHERE b.doc_id = x.doc_id)""",
    "mrg_delete_cascade": "SELECT l_orderkey, l_linenumber FROM {lineitem} l WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_orderstatus = 'P' AND o.o_orderkey = l.l_orderkey)",
    "join_overlay_update": """SELECT d.doc_id, coalesce(b.text, d.text) AS text, coalesce(substr(b.text, 1, 9), d.source) AS title, coalesce(nullif(CASE b.item_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'xx' END, ''), d.lang) AS lang FROM {documents} d LEFT JOIN {benchmark} b ON b.item_id = d.doc_id""",
    "sort_status_order": "SELECT o_orderkey, o_orderstatus FROM {orders} ORDER BY CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END, o_orderkey LIMIT 200",
    "topk_cap": """SELECT o.o_orderkey, f.o_orderkey IS NOT NULL AS taken FROM {orders} o LEFT JOIN (SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM {orders}) x WHERE rn <= 100) f ON f.o_orderkey = o.o_orderkey""",
    "mrg_least_greatest": """SELECT coalesce(a.k, b.k) AS k, least(a.f, b.f) AS first_seen, greatest(a.l, b.l) AS last_seen FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate AS DATE) AS l FROM {orders} WHERE o_orderkey % 3 <> 0) a
        FULL OUTER JOIN (SELECT l_orderkey AS k, min(CAST(l_shipdate AS DATE)) AS f, max(CAST(l_shipdate AS DATE)) AS l FROM {lineitem} GROUP BY l_orderkey) b ON b.k = a.k""",
    "flt_contains_ci": "SELECT p_partkey, p_name FROM {part} WHERE coalesce(lower(p_name) LIKE '%widget%', false) OR coalesce(lower(p_type) LIKE '%promo%', false)",
    "fn_null_pct": "SELECT round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE text IS NULL) / nullif(count(*), 0), 1) AS text_null_pct, round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE lang IS NULL) / nullif(count(*), 0), 1) AS lang_null_pct, round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE doc_id < 0 AND lang IS NULL) / nullif(count(*) FILTER (WHERE doc_id < 0), 0), 1) AS none_pct FROM {documents}",
    "fn_pct": "SELECT o_orderpriority, round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE o_orderstatus = 'F') / nullif(count(*), 0), 1) AS filled_pct, round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE o_orderstatus = 'F') / nullif(count(*) FILTER (WHERE o_orderstatus = 'X'), 0), 1) AS none_pct FROM {orders} GROUP BY o_orderpriority",
    "q_dashboard_kpis": """SELECT count(*) AS total, round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE o.o_orderstatus = 'F') / nullif(count(*), 0), 1) AS matched_pct, count(DISTINCT o.o_custkey) AS companies, round(CAST(100 AS DOUBLE) * count(s.l_orderkey) / nullif(count(*), 0), 1) AS skill_coverage_pct
        FROM {orders} o LEFT JOIN (SELECT DISTINCT l_orderkey FROM {lineitem}) s ON s.l_orderkey = o.o_orderkey""",
    "q_explore_counts": """SELECT 'orders' AS t, count(*) AS n, round(avg(o_totalprice), 2) AS mean, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM {orders} UNION ALL SELECT 'lineitem', count(*), round(avg(l_quantity), 2), min(l_quantity), max(l_quantity) FROM {lineitem}
        UNION ALL SELECT 'customer', count(*), round(avg(c_acctbal), 2), min(c_acctbal), max(c_acctbal) FROM {customer} UNION ALL SELECT 'supplier', count(*), round(avg(s_acctbal), 2), min(s_acctbal), max(s_acctbal) FROM {supplier}
        UNION ALL SELECT 'documents', count(*), round(avg(CAST(n_chars AS DOUBLE)), 2), CAST(min(n_chars) AS DOUBLE), CAST(max(n_chars) AS DOUBLE) FROM {documents}""",
    "q_salary": """SELECT o_orderstatus, count(*) AS n, count(*) FILTER (WHERE o_totalprice IS NULL) AS missing, count(*) FILTER (WHERE o_totalprice < 1000) AS too_low, count(*) FILTER (WHERE o_totalprice >= 1000) AS fine, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM {orders} GROUP BY o_orderstatus""",
    "q_parity": """SELECT coalesce(a.s, b.s) AS source, coalesce(a.n, 0) AS here, coalesce(b.n, 0) AS there, coalesce(a.n, 0) = coalesce(b.n, 0) AND coalesce(a.h, 0) = coalesce(b.h, 0) AS same FROM (SELECT source AS s, count(*) AS n, sum(doc_id) AS h FROM {documents} GROUP BY source) a
        FULL OUTER JOIN (SELECT source AS s, count(*) AS n, sum(doc_id) AS h FROM {documents} WHERE doc_id % 50 <> 7 GROUP BY source) b ON a.s IS NOT DISTINCT FROM b.s""",
    "q_corpus_checks": """SELECT count(*) AS n, count(*) - count(DISTINCT doc_id) AS duplicate_keys, count(*) FILTER (WHERE doc_id IS NULL) AS null_keys, count(DISTINCT source) AS sources, count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS blank_texts, count(*) FILTER (WHERE n_chars <> length(text)) AS wrong_lengths,
        count(*) > 0 AND CAST(1 AS DOUBLE) * (count(*) - count(DISTINCT doc_id)) / nullif(count(*), 0) < 0.05 AND count(*) FILTER (WHERE doc_id IS NULL) = 0 AND count(DISTINCT source) > 1 AS passed FROM {documents}""",
}


# ---- pages

_PATHS = ("/", "/news/x-job", "/jobs", "/job/123-dev", "/2026/10/21/x-job/", "/offer/driver-jobs", "/company/job-7", "/empleo/xyz", "/profile/7", "/job/today.html", "/saved/career-5", "/oglas/7")
_NAMES = ("", "Home", "Welder", "Driver Jobs", "ab", "Log in:", "Nurse (f/m/d)", " Chef ", "All jobs", "Teacher vacancies", "Clerk II")


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    url = F.when(F.col("page_id") % 17 != 16, F.concat(F.lit("https://www."), F.when(F.col("page_id") % 13 == 12, "Facebook.com").when(F.col("page_id") % 2 == 0, "jobs.site.test").otherwise("site.test"), _pick(_PATHS, "page_id"), F.when(F.col("page_id") % 4 == 1, "?q=job").otherwise("")))
    return p.select("page_id", url.alias("url"), _pick(_NAMES, "page_id").alias("title"), F.substring("html", 1, 40).alias("head"), F.col("html"), (F.col("page_id") % 5 != 4).alias("long"))


def flt_posting_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _postings(spark, sf_dir)
    body = F.when(F.col("long"), F.col("html")).otherwise(F.col("head"))
    return p.select("page_id", quality.reject_reason(F.col("url"), F.col("title"), body, F.lit("site.test"), "^/profile/").alias("reason"))


def src_html_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' own links, to which some that look like postings and some that do not are added."""
    more = F.concat(*[F.concat(F.lit(f'<a class="c" href="{h}'), F.col("page_id").cast("string"), F.lit('">t</a>')) for h in ("/job/a-", "career-", "/jobs-in-x/driver-jobs-in-x", "https://x.com/job/", "https://other.test/vacancy/", "/news/job/")])
    p = read(spark, sf_dir, "pages").where("html IS NOT NULL")
    return p.select("page_id", F.explode(quality.links(F.concat("html", more, more), F.lit("https://site.test/list?page=2"))).alias("link"))


def fn_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    host = quality.host_of(F.col("url"))
    return p.select("page_id", host.alias("host"), quality.same_site(host, F.lit("www.example.com")).alias("same_site"))


def flt_valid_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as bytes, every third with one that UTF-8 never holds, every fifth cut inside a letter."""
    raw = F.encode("text", "UTF-8")
    broken = F.when(F.col("doc_id") % 3 == 0, F.concat(raw, F.unhex(F.lit("FF")))).when(F.col("doc_id") % 5 == 0, F.concat(raw, F.unhex(F.lit("C3")))).otherwise(raw)
    return read(spark, sf_dir, "documents").select("doc_id", F.is_valid_utf8(broken.cast("string")).alias("fine"))


def fn_skill_scan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' whole texts, scanned for words of several languages, two of them short and in their own case."""
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(postings.skill_scan(F.col("text"), _TERMS), "|").alias("found"))


_PHRASES = ("PhD; visa sponsorship available.", "Physics. Hybrid; rotating shift, weekend work", "Remote, worldwide. No visa sponsorship, and no relocation.", "On-site. Relocation package. Night shift", "We cannot relocate you. Flexible hours, telework", "short", "From 9am to 5pm in an office")


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' whole texts, each with a posting's phrase behind it."""
    return read(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), _pick(_PHRASES, "doc_id")).alias("x"))


def fn_remote_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(spark, sf_dir).select("doc_id", postings.remote_type(F.col("x")).alias("remote_type"))


def fn_visa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(spark, sf_dir).select("doc_id", postings.stance(F.col("x"), postings.VISA).alias("visa"))


def fn_relocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(spark, sf_dir).select("doc_id", postings.stance(F.col("x"), postings.RELOCATION).alias("relocation"))


def fn_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(spark, sf_dir).select("doc_id", postings.work_schedule(F.col("x")).alias("schedule"))


_TERMS = ("The", "und", "dans", "para", "idiot", "De", "la")


def join_ref_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' nations, known there under other numbers; every fifth supplier has none."""
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("value"))
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 5 != 0, F.col("s_nationkey").cast("long")).alias("nation"))
    return store.translated(s, n, n.withColumn("id", F.col("id") * 10 + 3), "nation")


def mrg_remap_selfref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's later orders point at the first; both ends take their new numbers."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = o.join(o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first")), "o_custkey").select("o_orderkey", F.when(F.col("first") < F.col("o_orderkey"), F.col("first")).alias("duplicate_of"))
    return store.remapped(rows, "o_orderkey", "duplicate_of", o.select(F.col("o_orderkey").alias("old_id"), (F.col("o_orderkey") + 1_000_000).alias("new_id"))).select(F.col("o_orderkey").alias("id"), "duplicate_of")


def mrg_shard_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay that a shard brings: only where it is disclosed, and only for postings that have none yet."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("pay"))
    shard = o.select("k", (F.col("pay") + 1).alias("pay")).where("k % 2 = 0 AND k % 6 <> 0").unionByName(o.where("k % 10 = 0").select("k", (F.col("pay") + 2).alias("pay")))
    return merges.insert_missing(o.where("k % 4 = 0"), shard, "k", ["pay"])


def str_queue_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue seeded with sources, some claimed, of these some done and some failed; seeding again changes nothing."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"))
    empty = spark.createDataFrame([], "source long, status string, last date, errors int, note string")
    queue = merges.seed_queue(empty, s.where("source % 2 = 0"), "source")
    queue = merges.seed_queue(queue, s, "source")
    queue = merges.claim(queue, "source", "status", "last", 6)
    done = s.where("source % 3 = 0").select("source", F.lit(None).cast("string").alias("note")).unionByName(s.where("source % 3 = 1").select("source", F.lit("timeout").alias("note")))
    return merges.settle(queue, done, "source", F.lit("2024-01-05").cast("date"))


def flt_suspect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _postings(spark, sf_dir)
    path, body = quality.path_of(F.col("url")), F.when(F.col("long"), F.col("html")).otherwise(F.col("head"))
    return p.agg(F.count("*").alias("n"), F.count_if(path.rlike("/(?:news|company|saved)/")).alias("navigation_urls"), F.count_if(F.lower(F.trim("title")).isin(*markup.NAV_TITLES)).alias("navigation_titles"), F.count_if(F.length(body) < 200).alias("short"))


def src_sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sitemap of each language of pages, read back address by address."""
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})/", 1)
    p = read(spark, sf_dir, "pages").where("url IS NOT NULL").select(lang.alias("lang"), F.concat(F.lit("<url><loc>"), F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</loc><lastmod>2024</lastmod></url>")).alias("x"))
    xml = p.groupBy("lang").agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list("x"), "\n"), F.lit("</urlset>")).alias("xml"))
    return xml.select("lang", F.explode(sources.sitemap_urls(F.col("xml"))).alias("loc"))


# ---- completeness and batches

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic", "html", "item_text")


def agg_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, b, g, k = (read(spark, sf_dir, t) for t in ("documents", "labels", "pages", "benchmark"))
    rows = d.join(b, "doc_id", "left").join(g.select(F.col("page_id").alias("doc_id"), "html"), "doc_id", "left").join(k.select(F.col("item_id").alias("doc_id"), F.col("text").alias("item_text")), "doc_id", "left")
    return quality.completeness(rows, _COLUMNS)


def agg_nonnull_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders")
    return rows.agg(*[F.count(c).alias(c) for c in rows.columns])


def agg_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    parsed = d.where("doc_id % 10 <> 3").unionByName(d.where("doc_id < 40 AND doc_id % 20 = 0"))
    r = quality.batch_report(d, parsed, "doc_id", {"lang": F.col("lang").isNull(), "text": F.coalesce(F.trim("text") == "", F.lit(True))}, 10_000_000, 0.5)
    return r.select("total_raw", "total_parsed", F.round("skip_rate", 4).alias("skip_rate"), F.array_join(F.col("duplicate_ids").cast("array<string>"), ",").alias("duplicate_ids"), F.round("missing_lang", 4).alias("missing_lang"), F.round("missing_text", 4).alias("missing_text"), F.array_join("issues", ";").alias("issues"), "passed")


# ---- pay, days, digests

_PERIODS = ("hourly", "daily", "weekly", "monthly", "yearly", "Yearly")
_CURRENCIES = tuple(c for c, _ in salary.USD_RATES) + ("usd", "XXX")


def _paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("low"), (F.col("o_totalprice") * (1 + F.col("o_orderkey") % 8)).alias("high"), _pick(_PERIODS, "o_orderkey").alias("period"), _pick(_CURRENCIES, "o_orderkey").alias("currency"))


def fn_salary_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paid(spark, sf_dir).select("o_orderkey", *[salary.annual_usd(F.col(c), F.col("currency"), F.col("period")).alias(f"{c}_usd") for c in ("low", "high")])


def fn_salary_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the disclosed: every fourth order is not."""
    return _paid(spark, sf_dir).where("o_orderkey % 4 <> 3").select("o_orderkey", salary.anomaly(F.col("low") / F.when(F.col("o_orderkey") % 5 == 0, 500).otherwise(1), F.col("high")).alias("flag"))


def fn_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six parts: title, company, description, place, and both bounds, of which 0 and null are both empty."""
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), F.col("o_orderkey") == F.col("doc_id"), "left")
    number = lambda c: F.coalesce(F.nullif(c, F.lit(0)).cast("string"), F.lit(""))
    low, high = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")), F.col("o_orderkey") % 5
    return o.select("o_orderkey", entity.content_hash(F.concat(F.lit(" "), "o_orderpriority"), F.concat(F.lit("Firm "), "o_orderstatus", F.lit(" ")), F.col("text"), F.col("source"), number(low), number(high)).alias("content_hash"))


def fn_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", entity.quality_score(F.col("quality").isNotNull(), F.col("source"), F.col("lang").isNotNull(), F.coalesce(F.regexp_count("text", F.lit(r"[^ \t\n\r\f]+")), F.lit(0))).alias("score"))


def fn_script_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.script_language(F.col("text")).alias("script"))


CASES = {
    "fn_parse_date": Cases(1, {"day": "DATE"}, (
        ("2024-03-05", "2024-03-05"), ("2024/3/5", "2024-03-05"), ("05-03-2024", "2024-03-05"), ("5/3/2024", "2024-03-05"), ("5.3.2024", "2024-03-05"), ("Mar 5, 2024", "2024-03-05"), ("march 5, 2024", "2024-03-05"), ("5 Mar 2024", "2024-03-05"), (" 5 March 2024 ", "2024-03-05"),
        ("2024-03-05T10:00:00Z", "2024-03-05"), ("2024-13-05", None), ("31/02/2024", None), ("soon", None), ("", None), (None, None),
    ), lambda x: [postings.parse_day(x)]),
    "fn_relative_date": Cases(1, {"day": "DATE"}, (
        ("3 days ago", "2024-03-28"), ("Posted 2 weeks ago", "2024-03-17"), ("1 month ago", "2024-03-01"), ("5 hours ago", "2024-03-31"), ("yesterday", None), ("1 year ago", "2023-04-01"), ("פורסם לפני 3 ימים", "2024-03-28"), ("לפני 2 שבועות", "2024-03-17"), ("לפני 30 דקות", "2024-03-31"), ("לפני 1 חודש", "2024-03-01"), ("לפני 4", "2024-03-27"), ("", None), (None, None),
    ), lambda x: [postings.relative_day(x, F.lit("2024-03-31").cast("date"))]),
    "fn_experience_level": Cases(3, {"level": TEXT}, (
        ("Senior Clerk", "1 year experience", "2", "senior"), ("Clerk", "3 to 5 years of experience", "9", "lead"), ("Clerk", "3 to 5 years of experience", None, "mid"), ("Clerk", "fresh graduate", "0", "entry"), ("Clerk", "fresh graduate", None, "entry"), (None, None, "12", "principal"), (None, None, None, None), ("Team Lead", "", None, "lead"), ("", "10+ yrs experience", None, "lead"),
    ), lambda t, x, n: [postings.experience_level(t, x, n.cast("int"))]),
    "fn_education_level": Cases(1, {"level": TEXT}, (
        ("PhD or master's degree", "phd"), ("Bachelor's degree in physics", "bachelor"), ("High school diploma", "high_school"), ("Aucun diplôme", "none"), ("فوق لیسانس", "master"), ("mit Abitur", "high_school"), ("CPA required", "professional_certification"), ("Ausbildung", "associate"), ("whatever", None), ("", None), (None, None), ("Bac + 5 ou Bac + 3", "master"),
    ), lambda x: [postings.education_level(x)]),
    "fn_clean_title": Cases(1, {"cleaned": TEXT}, (
        ("Senior DevOps Engineer (Linux, PHP)", "Senior DevOps Engineer"), ("Team Lead [urgent]", "Team Lead"), ("Junior Analyst - remote", "Junior Analyst"), ("Staff Engineer (m/w/d) - Full-time", "Staff Engineer"), ("Sr. C++ / Go Developer, hybrid", "Sr C / Go Developer"), ("Mid-level R&D Chemist", "Mid-level R&D Chemist"), ("Müller!  Gehilfe", "Müller Gehilfe"), ("", ""), (None, None),
    ), lambda x: [postings.clean_title(x)]),
    "fn_core_title": Cases(1, {"core": TEXT}, (
        ("Senior DevOps Engineer", "DevOps Engineer"), ("Team Lead", "Team Lead"), ("Junior Analyst", "Analyst"), ("head of  Sales", "Sales"), ("Sr C / Go Developer", "C / Go Developer"), ("Internal Auditor", "Internal Auditor"), ("Lead", "Lead"), ("", ""), (None, None),
    ), lambda x: [postings.core_title(x)]),
    "fn_boilerplate": Cases(1, {"rest": TEXT}, (
        ("We build. Please mention the word **ABLE** and tag Rabc when applying. This is a beta feature to avoid spam applicants.", "We build."), ("Please mention the word only", "Please mention the word only"), (" x ", "x"), ("", ""), (None, ""),
    ), lambda x: [postings.without_boilerplate(x)]),
    "fn_json_dotted": Cases(1, {"many": TEXT, "one": TEXT}, (
        ('{"a":{"b":[{"c":1},{"c":null},{"c":""},{"c":"x"}]},"d":{"e":2.5}}', '[1,"x"]', "2.5"), ('{"a":{"b":{"c":"only"}},"d":{"e":[1,{}]}}', '["only"]', "[1,{}]"), ('{"a":{"b":[]}}', "[]", None), ('{"a":[1],"d":"e"}', None, None), ("[]", None, None), ("no", None, None), ("", None, None), (None, None, None),
    ), lambda x: [markup.json_walk(x, "a.b[].c"), markup.json_walk(x, "d.e")]),
    "fn_json_map": Cases(1, {"location": TEXT, "body": TEXT}, (
        ('{"city":"Oslo","state":"","land":["NO",null,"SE"],"parts":[{"t":"one"},{"t":"two"}]}', "Oslo, NO, SE", "one\ntwo"), ('{"city":null,"land":"DK"}', "DK", ""), ("{}", "", ""), ('{"city":3,"parts":{"t":"x"}}', "3", "x"), (None, None, None),
    ), lambda x: [markup.json_joined(x, ["city", "state", "land"], ", "), markup.json_joined(x, ["parts[].t"])]),
}

# ---- duplicates, titles, places, vectors


def dedup_cross_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as postings by their status and the customer's segment and nation, written in different ways."""
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = o.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("source"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderkey") % 4).alias("trust"), (F.col("o_orderkey") % 3).alias("digest"),
                    F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Job, "), "o_orderstatus")).otherwise(F.concat(F.lit(" JOB  "), "o_orderstatus")).alias("title"), F.concat("c_mktsegment", F.lit(" & "), F.col("c_nationkey").cast("string")).alias("company"))
    return entity.cross_source_duplicates(rows, "title", "company", "source", "day", "o_orderkey", "trust", "digest", 30)


def title_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' names as titles: by name, by core, by their vectors, and one kind of text that is no posting."""
    own = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    named = F.when(F.col("p_partkey") % 11 == 0, "test 1").when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("Senior "), "p_name")).when(F.col("p_partkey") % 3 == 2, F.concat("p_name", F.lit(" (Remote)"))).otherwise(F.col("p_name"))
    jobs = own.select("p_partkey", named.alias("title")).withColumn("cleaned", postings.clean_title(F.col("title"))).withColumn("core", postings.core_title(F.col("cleaned"))).withColumn("non_job", postings.is_non_job(F.col("title"), F.lit("a long enough description of the work")))
    taxonomy = own.where("p_partkey % 5 = 0 AND p_name NOT LIKE '%bolt%'").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    # a title's vector: here the share of its letters that are a, e and o
    share = lambda c: F.array(*[F.regexp_count(F.lower(c), F.lit(x)).cast("double") + 0.25 * k for k, x in enumerate("aeo")])
    return merges.classify_titles(jobs.withColumn("vector", share(F.col("cleaned"))), taxonomy.withColumn("vector", share(F.col("name"))), "cleaned", "core", "non_job", "vector", 0.99).select("p_partkey", "title_id", F.round("confidence", 2).alias("confidence"), "status")


_PLACES = ("City, State", "Remote - City", "City 12", "City, ST 94105", "State", "co. State", "Georgia", "GB", "uk", "Worldwide", "nowhere", "", "x; State; City", "remote work in City (Centre)", "Town, ca", "elsewhere, de", None)
_HOMES = (None, "us", "GE", "XX")


def geo_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of places on customers of boards at home in different countries."""
    c = read(spark, sf_dir, "customer").select("c_custkey", _pick(_PLACES, "c_custkey").alias("raw"), F.element_at(F.array(*[F.lit(h).cast("string") for h in _HOMES]), (F.floor(F.col("c_custkey") / len(_PLACES)) % len(_HOMES) + 1).cast("int")).alias("home"))
    named = "id long, name string"
    cities, regions = spark.createDataFrame([(1, "City"), (2, "Twin"), (3, "twin")], named), spark.createDataFrame([(11, "State"), (12, "Georgia"), (13, "California"), (14, "Delaware")], named)
    countries = spark.createDataFrame([(21, "Georgia", "GE", "GEO"), (22, "United Kingdom", "GB", "GBR"), (23, "United States", "US", "USA"), (24, "Germany", "DE", "DEU")], f"{named}, iso_code_2 string, iso_code_3 string")
    return places.resolve(c, "raw", cities, regions, countries, "home").select("c_custkey", "place_level", "place_id", "place_method")


def sort_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's nearest label centre by cosine, the first label of equal ones: one projection over the centres, a row for each label."""
    e = read(spark, sf_dir, "embeddings")
    centres = entity.bounded_rows(e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("centre")).orderBy("label"), 1000)

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)

    own = e.select("vec_id", "embedding", dot("embedding", "embedding").alias("square"))
    scores = []
    for r in centres:
        c = F.array(*[F.lit(float(x)) for x in r["centre"]])
        size = sum(float(x) * float(x) for x in r["centre"]) ** 0.5
        scores.append(F.struct(F.round(dot("embedding", c) / (F.sqrt("square") * F.lit(size)), 4).alias("cosine"), F.lit(-r["label"]).alias("l")))
    best = F.array_max(F.array(*scores)) if scores else F.lit(None).cast("struct<cosine:double,l:int>")
    return own.select("vec_id", best.alias("b")).select("vec_id", (-F.col("b.l")).cast("int").alias("label"), "b.cosine")


FRAMES = {f.__name__: f for f in (fn_remote_type, fn_visa, fn_relocation, fn_schedule, flt_valid_utf8, fn_skill_scan_texts, join_ref_translate, mrg_remap_selfref, mrg_shard_children, str_queue_cycle, flt_posting_quality, src_html_listing, fn_host, flt_suspect_rows, src_sitemap, agg_completeness, agg_nonnull_by_column, agg_batch_report, fn_salary_usd, fn_salary_anomaly, fn_content_hash, fn_quality_score, fn_script_lang, dedup_cross_source, title_class, geo_resolve, sort_argmax)}


def _list(items) -> str:
    return "[" + ", ".join("NULL" if x is None else "'" + x.replace("'", "''") + "'" for x in items) + "]"


_RATES = "(VALUES " + ", ".join(f"('{c}', {r!r}::DOUBLE)" for c, r in (
    ("USD", 1.0), ("GBP", 1.3240), ("DZD", 0.007462), ("MUR", 0.02077), ("CNY", 0.1492), ("EGP", 0.01868297436), ("SAR", 0.2666666667), ("AED", 0.2722940776), ("GEL", 0.3850574602), ("AZN", 0.5886196281), ("MYR", 0.2450040609), ("ZAR", 0.0608742393), ("IRT", 6.036086175e-07), ("NPR", 0.00746),
    ("THB", 0.0274), ("CAD", 0.735), ("BDT", 0.0082), ("BTN", 0.011940), ("QAR", 0.2747252747), ("KRW", 0.00072), ("UYU", 0.023), ("MMK", 0.00048), ("XOF", 0.0016), ("LKR", 0.00300818), ("CDF", 0.00043257), ("CHF", 1.1856250), ("MNT", 0.00029412))) + ") r(c, f)"
_PAID = f"""(SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS low, o_totalprice * (1 + o_orderkey % 8) AS high, {_list(_PERIODS)}[o_orderkey % 6 + 1] AS period, {_list(_CURRENCIES)}[o_orderkey % {len(_CURRENCIES)} + 1] AS currency FROM orders)"""
_SITE_PATH = f"{_list(_PATHS)}[page_id % {len(_PATHS)} + 1]"
_SITE_NAME = f"{_list(_NAMES)}[page_id % {len(_NAMES)} + 1]"
_BODY_CHARS = "length(CASE WHEN page_id % 5 <> 4 THEN trim(html) ELSE trim(substr(html, 1, 40)) END)"
_PLACE_ANSWERS = {  # of each spelling: level, id and method on a board of no known home, of the US, of Georgia, of an unknown country
    "City, State": (4, 1), "Remote - City": (4, 1), "City 12": (4, 1), "City, ST 94105": (4, 1), "State": (3, 11), "co. State": (3, 11), "GB": (2, 22), "uk": (2, 22), "Worldwide": (1, None), "": (1, None), "x; State; City": (4, 1), "remote work in City (Centre)": (4, 1),
}


def _place_case() -> str:
    methods = {4: "city_exact", 3: "region_exact", 2: "country_exact", 1: "global_assertion"}
    rows = []
    for i, raw in enumerate(_PLACES):
        for j, home in enumerate(_HOMES):
            us = home in (None, "us")
            if raw in _PLACE_ANSWERS:
                level, key = _PLACE_ANSWERS[raw]
                found = (level, key, methods[level])
            elif raw == "Georgia":
                found = (3, 12, "region_exact") if us else (2, 21, "country_exact")
            elif raw == "Town, ca" and us:
                found = (3, 13, "region_exact")
            elif raw == "elsewhere, de":
                found = (3, 14, "region_exact") if us else (2, 24, "country_exact")
            else:
                key = None if raw is None else {"us": 23, "GE": 21}.get(home)
                found = (2, key, "source_default_country") if key else (0, None, "fallback_unmatched")
            rows.append(f"({i}, {j}, {found[0]}, {'NULL' if found[1] is None else found[1]}::BIGINT, '{found[2]}')")
    return f"(VALUES {', '.join(rows)}) a(i, j, place_level, place_id, place_method)"


_DESCRIBED = f"(SELECT doc_id, coalesce(text, '') || chr(10) || {_list(_PHRASES)}[doc_id % {len(_PHRASES)} + 1] AS x FROM documents)"
FRAMES_SQL = {
    "fn_remote_type": f"SELECT doc_id, CASE WHEN x ILIKE '%hybrid%' THEN 'hybrid' WHEN (x ILIKE '%remote%' OR x ILIKE '%telework%') AND x ILIKE '%worldwide%' THEN 'remote_global' WHEN x ILIKE '%remote%' OR x ILIKE '%telework%' THEN 'remote_country' WHEN x ILIKE '%on-site%' THEN 'on_site' END AS remote_type FROM {_DESCRIBED}",
    "fn_visa": f"SELECT doc_id, CASE WHEN x ILIKE '%visa sponsorship available%' THEN true WHEN x ILIKE '%no visa sponsorship%' THEN false END AS visa FROM {_DESCRIBED}",
    "fn_relocation": f"SELECT doc_id, CASE WHEN x ILIKE '%relocation package%' THEN true WHEN x ILIKE '%no relocation%' OR x ILIKE '%cannot relocate%' THEN false END AS relocation FROM {_DESCRIBED}",
    "fn_schedule": f"SELECT doc_id, CASE WHEN x ILIKE '%night shift%' THEN 'night_shift' WHEN x ILIKE '%weekend work%' THEN 'weekend' WHEN x ILIKE '%flexible hours%' THEN 'flexible' WHEN x ILIKE '%9am to 5pm%' THEN 'standard_day' END AS schedule FROM {_DESCRIBED}",
    "flt_valid_utf8": "SELECT doc_id, CASE WHEN text IS NOT NULL THEN doc_id % 3 <> 0 AND doc_id % 5 <> 0 END AS fine FROM documents",
    "fn_skill_scan_texts": r"""SELECT doc_id, array_to_string(list_filter(['De', 'The', 'dans', 'idiot', 'la', 'para', 'und'], lambda t: regexp_matches(coalesce(text, ''), CASE WHEN length(t) <= 2 THEN '(^|[^A-Za-z0-9&/-])' || t || '([^A-Za-z0-9&/-]|$)' ELSE '(?i)(^|[^A-Za-z0-9])' || t || '([^A-Za-z0-9]|$)' END)), '|') AS found FROM documents""",
    "join_ref_translate": "SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN s_nationkey * 10 + 3 END::BIGINT AS nation FROM supplier",
    "mrg_remap_selfref": "SELECT o_orderkey + 1000000 AS id, CASE WHEN min(o_orderkey) OVER (PARTITION BY o_custkey) < o_orderkey THEN min(o_orderkey) OVER (PARTITION BY o_custkey) + 1000000 END AS duplicate_of FROM orders",
    "mrg_shard_children": "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice WHEN o_orderkey % 2 = 0 AND o_orderkey % 6 <> 0 THEN o_totalprice + 1 ELSE o_totalprice + 2 END AS pay FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 2 = 0 AND o_orderkey % 6 <> 0 OR o_orderkey % 10 = 0",
    "str_queue_cycle": """WITH c AS (SELECT s_suppkey AS k, row_number() OVER (ORDER BY s_suppkey) <= 6 AS mine FROM supplier)
        SELECT k AS source, CASE WHEN NOT mine THEN 'pending' WHEN k % 3 = 0 THEN 'done' WHEN k % 3 = 1 THEN 'failed' ELSE 'in_progress' END AS status, CASE WHEN mine AND k % 3 <> 2 THEN DATE '2024-01-05' END AS last, CASE WHEN mine AND k % 3 = 1 THEN 1 ELSE 0 END AS errors, CASE WHEN mine AND k % 3 = 1 THEN 'timeout' END AS note FROM c""",
    "flt_posting_quality": rf"""WITH p AS (SELECT page_id, page_id % 17 = 16 AS none, page_id % 13 = 12 AS off, lower({_SITE_PATH}) AS path, trim({_SITE_NAME}) AS t, {_BODY_CHARS} AS n FROM pages),
        q AS (SELECT *, trim(lower(t), ' .:!-–—') AS bare, regexp_extract(path, '([^/]*)/*$', 1) AS last, CASE WHEN path = '/' THEN 'site root, not a posting' WHEN off THEN 'offsite link (facebook.com)' WHEN path LIKE '/profile/%' THEN NULL WHEN path LIKE '/news/%' THEN 'section path (news)'
          WHEN path LIKE '/company/%' THEN 'section path (company)' WHEN path LIKE '/2026/10/21/%' THEN 'news article path (dated)' WHEN path = '/jobs' THEN 'listing page (/jobs)' WHEN path = '/job/today.html' THEN 'listing page (/today.html)' WHEN path = '/offer/driver-jobs' THEN 'category path (ends in -jobs)' END AS by_path FROM p)
        SELECT page_id, CASE WHEN none THEN 'no url' ELSE coalesce(by_path, CASE WHEN t = '' THEN 'no title' WHEN bare IN ('home', 'log in', 'all jobs') THEN 'navigation title' WHEN bare LIKE '% jobs' OR bare LIKE '% vacancies' THEN 'category title' WHEN length(t) < 3 THEN 'title too short'
          WHEN n < 80 THEN 'no job description (' || n || ' chars)' END) END AS reason FROM q""",
    "src_html_listing": "SELECT page_id, 'https://site.test/job/a-' || page_id AS link FROM pages WHERE html IS NOT NULL UNION ALL SELECT page_id, 'https://site.test/career-' || page_id FROM pages WHERE html IS NOT NULL UNION ALL SELECT page_id, 'https://other.test/vacancy/' || page_id FROM pages WHERE html IS NOT NULL",
    "fn_host": r"""SELECT page_id, host, coalesce(host = 'example.com' OR host LIKE '%.example.com', false) AS same_site FROM (SELECT page_id, regexp_replace(lower(nullif(regexp_extract(url, '^[a-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')), '^www[.]', '') AS host FROM pages)""",
    "flt_suspect_rows": f"""SELECT count(*) AS n, count(*) FILTER (WHERE page_id % 17 <> 16 AND regexp_matches({_SITE_PATH}, '^/(news|company|saved)/')) AS navigation_urls, count(*) FILTER (WHERE {_SITE_NAME} IN ('Home', 'All jobs')) AS navigation_titles,
        count(*) FILTER (WHERE length(CASE WHEN page_id % 5 <> 4 THEN html ELSE substr(html, 1, 40) END) < 200) AS short FROM pages""",
    "src_sitemap": r"SELECT regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) AS lang, url AS loc FROM pages WHERE url IS NOT NULL",
    "agg_completeness": "WITH j AS (SELECT d.*, b.quality, b.toxic, g.html, k.text AS item_text FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id LEFT JOIN pages g ON g.page_id = d.doc_id LEFT JOIN benchmark k ON k.item_id = d.doc_id) " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, round(100.0::DOUBLE * (count(*) - count({c})) / nullif(count(*), 0), 1) AS null_pct FROM j" for c in _COLUMNS),
    "agg_nonnull_by_column": "SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey, count(o_orderstatus) AS o_orderstatus, count(o_totalprice) AS o_totalprice, count(o_orderdate) AS o_orderdate, count(o_orderpriority) AS o_orderpriority FROM orders",
    "agg_batch_report": """WITH p AS (SELECT * FROM documents WHERE doc_id % 10 <> 3 UNION ALL SELECT * FROM documents WHERE doc_id < 40 AND doc_id % 20 = 0)
        SELECT (SELECT count(*) FROM documents) AS total_raw, count(*) AS total_parsed, round(((SELECT count(*) FROM documents) - count(*)) / (SELECT count(*) FROM documents)::DOUBLE, 4) AS skip_rate, '0,20' AS duplicate_ids, round(count(*) FILTER (WHERE lang IS NULL) / count(*)::DOUBLE, 4) AS missing_lang,
        round(count(*) FILTER (WHERE coalesce(trim(text, ' '), '') = '') / count(*)::DOUBLE, 4) AS missing_text, 'too few parsed;duplicate ids' AS issues, false AS passed FROM p""",
    "fn_salary_usd": f"""SELECT o_orderkey, floor(low * m.f * r.f * 100 + 0.5) / 100 AS low_usd, floor(high * m.f * r.f * 100 + 0.5) / 100 AS high_usd FROM {_PAID} o LEFT JOIN (VALUES ('hourly', 2080.0::DOUBLE), ('daily', 260), ('weekly', 52), ('monthly', 12), ('yearly', 1)) m(p, f) ON m.p = o.period LEFT JOIN {_RATES} ON r.c = upper(o.currency)""",
    "fn_salary_anomaly": f"""SELECT o_orderkey, CASE WHEN low IS NULL OR high IS NULL THEN 'missing normalized value despite salary_disclosed=true' WHEN low < 1000 THEN 'implausibly low for an annual figure - likely un-annualized rate'
        WHEN high / low > 5 THEN 'min/max spread is ' || round_even(high / low, 0)::BIGINT || 'x - check pay-period/currency conversion' ELSE '' END AS flag FROM (SELECT o_orderkey, low / CASE WHEN o_orderkey % 5 = 0 THEN 500 ELSE 1 END AS low, high FROM {_PAID}) WHERE o_orderkey % 4 <> 3""",
    "fn_content_hash": """SELECT o_orderkey, sha256(trim(o_orderpriority) || '|' || 'firm ' || lower(o_orderstatus) || '|' || regexp_replace(coalesce(text, ''), '^[\\s\\x1c-\\x1f\\x{0085}\\p{Z}]+|[\\s\\x1c-\\x1f\\x{0085}\\p{Z}]+$', '', 'g') || '|' || lower(coalesce(source, '')) || '|' || CASE WHEN o_orderkey % 3 <> 0 AND o_custkey <> 0 THEN o_custkey::VARCHAR ELSE '' END || '|' ||
        CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 5)::VARCHAR ELSE '' END) AS content_hash FROM orders LEFT JOIN documents ON doc_id = o_orderkey""".replace("\\\\", "\\"),
    "fn_quality_score": r"""SELECT d.doc_id, round(((b.quality IS NOT NULL)::INT + (source IS NOT NULL AND source <> '')::INT + (lang IS NOT NULL)::INT + (coalesce(len(regexp_extract_all(text, '[^ \t\n\r\f]+')), 0) >= 20)::INT) / 4.0::DOUBLE, 2) AS score FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id""",
    "fn_script_lang": f"SELECT doc_id, {_script_of('text')} AS script FROM documents",
    "dedup_cross_source": """WITH r AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day, o_orderpriority AS s, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 4 END AS trust, o_orderkey % 3 AS h, 'job ' || lower(o_orderstatus) AS t, lower(c_mktsegment) || ' ' || c_nationkey AS c FROM orders JOIN customer ON c_custkey = o_custkey),
        f AS (SELECT *, first_value(k) OVER w AS ck, first_value(s) OVER w AS cs, first_value(day) OVER w AS cd, first_value(h) OVER w AS ch FROM r WINDOW w AS (PARTITION BY t, c ORDER BY coalesce(trust, -1) DESC, day, k))
        SELECT k AS duplicate, day AS duplicate_day, s AS duplicate_source, ck AS canonical, cd AS canonical_day, cs AS canonical_source, t AS normalized_title, c AS normalized_company, h = ch AS content_hash_matched FROM f WHERE k <> ck AND s <> cs AND abs(datediff('day', cd, day)) <= 30""",
    "title_class": f"""WITH x AS (SELECT p_name AS name, min(p_partkey) AS id FROM part WHERE p_partkey % 5 = 0 AND p_name NOT LIKE '%bolt%' GROUP BY 1), v AS (SELECT *, [{', '.join(f"(length(name) - length(replace(lower(name), '{x}', '')))::DOUBLE + {0.25 * k}" for k, x in enumerate('aeo'))}] AS e FROM x),
        t AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 1 THEN 'Senior ' || p_name ELSE p_name END AS cleaned FROM part WHERE p_partkey % 11 <> 0), u AS (SELECT DISTINCT cleaned, [{', '.join(f"(length(cleaned) - length(replace(lower(cleaned), '{x}', '')))::DOUBLE + {0.25 * k}" for k, x in enumerate('aeo'))}] AS e FROM t),
        b AS (SELECT cleaned, arg_max(id, (s, -id)) AS id, max(s) AS s FROM (SELECT u.cleaned, v.id, round(list_cosine_similarity(u.e, v.e), 6) AS s FROM u CROSS JOIN v) GROUP BY cleaned)
        SELECT p_partkey, CASE WHEN x.id IS NOT NULL THEN x.id WHEN b.s >= 0.99 THEN b.id END AS title_id, CASE WHEN x.id IS NOT NULL THEN CASE WHEN p_partkey % 3 = 1 THEN 0.95 ELSE 1.0 END ELSE round(b.s, 2) END::DOUBLE AS confidence,
        CASE WHEN x.id IS NOT NULL OR b.s >= 0.99 THEN 'matched' ELSE 'no_match' END AS status FROM t LEFT JOIN x ON x.name = t.p_name LEFT JOIN b ON b.cleaned = t.cleaned UNION ALL SELECT p_partkey, NULL, NULL, 'excluded_non_job' FROM part WHERE p_partkey % 11 = 0""",
    "geo_resolve": f"SELECT c_custkey, place_level, place_id, place_method FROM customer JOIN {_place_case()} ON a.i = c_custkey % {len(_PLACES)} AND a.j = c_custkey // {len(_PLACES)} % {len(_HOMES)}",
    "sort_argmax": """WITH c AS (SELECT label, arg_min(embedding, vec_id) AS centre FROM embeddings GROUP BY label),
        s AS (SELECT e.vec_id, c.label, round(list_cosine_similarity(e.embedding::DOUBLE[], c.centre::DOUBLE[]), 4) AS cosine FROM embeddings e JOIN c ON true)
        SELECT vec_id, label, cosine FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, label) = 1""",
}


def queries() -> dict:
    return CASES | FRAMES


def oracle_sql() -> dict[str, str]:
    return {k: c.oracle() for k, c in CASES.items()} | FRAMES_SQL
