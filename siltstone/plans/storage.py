"""Queries of readers, writers, store operators and streams, with their oracle statements.

Each writes what it needs under the work folder and reads it back, so the plan
that the oracle is held against is the reader's own.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import entity, store
from siltstone.sinks import files as sinks
from siltstone.sources import files as sources
from siltstone.sources.tables import read, work_dir
from siltstone.streaming import incremental


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("day"))


def _shards(spark: SparkSession, sf_dir: str) -> str:
    """Documents as shards by source and day."""
    root = work_dir(spark, "shards")
    d = read(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 3).cast("int")).alias("dt"))
    d.where("source IS NOT NULL").repartition("source").write.partitionBy("source", "dt").parquet(root)
    return root


def src_parquet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.shards(spark, _shards(spark, sf_dir), "doc_id long, n_chars long").where("dt >= DATE '2024-01-02'").groupBy("source", "dt").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def src_parquet_footer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(sources.row_count(spark, [f"{sf_dir}/lineitem.parquet", f"{sf_dir}/lineitem.parquet"]),)], "n long")


def src_partition_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.schema("doc_id long").option("recursiveFileLookup", True).parquet(_shards(spark, sf_dir))
    return rows.select("doc_id", sources.source_of_path(F.input_file_name()).alias("part"))


def src_parquet_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost, more = sources.schema_check(spark, f"{sf_dir}/documents.parquet", ("doc_id", "text", "lang", "title"))
    return spark.createDataFrame([(c, "missing") for c in lost] + [(c, "extra") for c in more], "column string, state string")


def set_schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost, more = sources.schema_diff(read(spark, sf_dir, "orders").columns, read(spark, sf_dir, "lineitem").columns)
    return spark.createDataFrame([(c, "right") for c in lost] + [(c, "left") for c in more], "column string, side string")


def src_overlay_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "overlay")
    d = read(spark, sf_dir, "documents")
    d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.col("lang")).alias("title_en"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("language_code")).write.parquet(path)
    return sources.overlay_rows(spark, path, ["doc_id"], ["title_en", "language_code", "description_en"])


def src_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "scan_" + work_dir(spark, "x").rsplit("-", 1)[1]
    read(spark, sf_dir, "supplier").createOrReplaceTempView(name)
    return sources.table(spark, name, ["s_suppkey", "s_name"], "s_acctbal > 0")


def src_paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.paged(_orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", 500).groupBy("page").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


def src_json_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' payloads as landed responses, some of them failed, some no JSON."""
    e = read(spark, sf_dir, "events")
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 201, 404, 429, 503, None, 200)]), (F.col("event_id") % 7 + 1).cast("int"))
    landed = e.select("event_id", status.alias("status"), F.when(F.col("event_id") % 7 == 6, "<html>").otherwise(F.col("props")).alias("body"))
    rows = sources.json_rows(landed, "body", "struct<k:long>")
    states = landed.select("event_id", sources.outcome(F.col("status")).alias("outcome"))
    return states.join(rows.select("event_id", F.col("body.k").alias("k")), "event_id", "left")


def src_html_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as whole files, a folder of them read as rows of path and content."""
    root = work_dir(spark, "html")
    read(spark, sf_dir, "pages").where("page_id < 40").select("html", F.col("page_id").cast("string").alias("page")).repartition("page").write.partitionBy("page").text(root, lineSep="\u0000")
    rows = spark.read.text(root, wholetext=True)
    return rows.select(F.col("page").cast("long").alias("page_id"), F.length(F.regexp_replace("value", "\u0000$", "")).cast("long").alias("n_chars"))


def src_rss_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as feeds, one of each nation, read back item by item."""
    s = read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("<item><title>"), "s_name", F.lit("</title><link>u?a=1&amp;b="), F.col("s_suppkey").cast("string"), F.lit("</link></item>")))), ""), F.lit("</channel></rss>")).alias("xml"))
    return s.select("s_nationkey", F.explode(sources.feed_items(F.col("xml"), ("title", "link"))).alias("i")).select("s_nationkey", "i.title", "i.link")


def src_browser(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.element_at(F.array(*map(F.lit, ("A job", "Just a moment...", "Access Denied", "Fine"))), (F.col("page_id") % 4 + 1).cast("int"))
    body = F.when(F.col("page_id") % 8 == 3, " ").when(F.col("page_id") % 8 == 7, F.concat(F.lit("Please verify you are human "), "html")).otherwise(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", sources.rendered_state(title, body).alias("state"))


def _tried(spark: SparkSession, failures: int, attempts: int, least: float, most: float) -> DataFrame:
    waited, left = [], [failures]

    def call() -> int:
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("again")
        return 7

    value = sources.retried(call, attempts, least, most, sleep=waited.append)
    return spark.createDataFrame([(i, w, value) for i, w in enumerate(waited)], "i int, seconds double, value int")


def src_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tried(spark, 2, 3, 1.0, 90.0)


def src_hf_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tried(spark, 6, 7, 3.0, 90.0)


def src_seed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = sources.seed(spark, [(1, "1-URGENT"), (2, "2-HIGH"), (5, "5-LOW")], "level int, name string")
    return _orders(spark, sf_dir).join(F.broadcast(levels), F.col("o_orderpriority") == F.col("name"), "left").groupBy("level").agg(F.count("*").alias("n"))


def src_site_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "configs")
    c = read(spark, sf_dir, "supplier").select(F.concat(F.lit('{\n "source_code": "'), "s_name", F.lit('",\n "base_url": "https://x.test/'), F.col("s_suppkey").cast("string"), F.lit('",\n "selectors": {"job_link": "a.'), F.col("s_nationkey").cast("string"), F.lit('"},\n "unknown": [1],\n "min_description_chars": '), F.col("s_nationkey").cast("string"), F.lit("}")).alias("value"), F.col("s_suppkey").alias("site"))
    c.repartition("site").write.partitionBy("site").text(path)
    return sources.site_configs(spark, path).select("source_code", "base_url", F.col("selectors.job_link").alias("job_link"), "listing_path", "min_description_chars")


def src_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two kinds of source, each read by its own rows of one mapping."""
    e = read(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"a":{"id":'), "event_id", F.lit('},"p":'), "props", F.lit("}")).alias("body"), F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd").alias("source"))
    mapping = spark.createDataFrame([("even", "job_id", "a.id"), ("even", "value", "p.k"), ("odd", "number", "a.id"), ("none", "x", "y")], "source string, field string, path string")
    return sources.mapped(e, "body", "source", mapping)


# ---- sinks


def sink_shard_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports: the first of early events, the second of what came since; nothing is written twice."""
    root = work_dir(spark, "export")
    e = read(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    half = e.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    for stamp, rows in (("1", e.where(F.col("ts") <= F.lit(half))), ("2", e), ("3", e)):
        sinks.export_newer(rows, f"{root}/shards", f"{root}/state", "event_type", "ts", stamp)
    marks = sinks.read_state(spark, f"{root}/state")
    top = spark.createDataFrame(sorted(marks.items()), "event_type string, mark string")
    rows = spark.read.schema("event_id long, ts timestamp_ntz, stamp int, event_type string").parquet(f"{root}/shards")
    counts = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("events"), F.max("stamp").alias("stamps"))
    return counts.join(top, "event_type").select("event_type", "n", "events", "stamps", F.col("mark").cast("timestamp_ntz").alias("mark"))


def sink_snapshot_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of all sources, then one of two of them with fewer rows: the others' files stay."""
    root = work_dir(spark, "snapshot")
    d = read(spark, sf_dir, "documents").where("source IS NOT NULL").select("doc_id", "source")
    sinks.snapshot(d, root, "source")
    sinks.snapshot(d.where("source IN ('src0', 'src1') AND doc_id % 2 = 0"), root, "source")
    return spark.read.schema("doc_id long, source string").parquet(root).groupBy("source").agg(F.count("*").alias("n"))


_REFERENCES = {"region": set(), "nation": {"region"}, "supplier": {"nation"}, "customer": {"nation"}, "orders": {"customer"}}


def _dumped(spark: SparkSession, sf_dir: str) -> str:
    root = work_dir(spark, "state")
    sinks.dump({t: read(spark, sf_dir, t) for t in (*_REFERENCES, "lineitem")}, root, leave_out=("lineitem",))
    return root


def sink_state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _dumped(spark, sf_dir)
    parts = [spark.read.parquet(f"{root}/{t}").agg(F.lit(t).alias("name"), F.count("*").alias("n")) for t in _REFERENCES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sink_state_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in the order they are loaded, their rows and next free ids."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey", "customer": "c_custkey", "orders": "o_orderkey"}
    tables, free = sinks.restore(spark, _dumped(spark, sf_dir), _REFERENCES, keys)
    rows = [(i, t, tables[t].count(), free[t]) for i, t in enumerate(tables)]
    return spark.createDataFrame(rows, "place int, name string, n long, next_id long")


def sink_copy_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    patch = o.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("a").alias("title")).unionByName(o.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit("b").alias("title")))
    return sinks.staged(patch, o.select("o_orderkey", "o_custkey"), ["o_orderkey"])


def sink_audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "audit")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    after = s.where("s_suppkey % 7 <> 0").withColumn("s_nationkey", F.when(F.col("s_suppkey") % 5 == 0, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey")))
    for part in (0, 1):
        mine = F.col("s_suppkey") % 2 == part
        sinks.audit(s.where(mine & (F.col("s_suppkey") % 11 != 0)), after.where(mine), "s_suppkey", "supplier", ["s_name", "s_nationkey"]).write.mode("append").parquet(path)
    log = spark.read.parquet(path)
    return log.select("table_name", "record_id", "operation", F.get_json_object("old_data", "$.s_nationkey").alias("was"), F.get_json_object("new_data", "$.s_nationkey").alias("now"))


def sink_report_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = _orders(spark, sf_dir).groupBy("o_orderstatus").agg(F.count("*").alias("n")).orderBy("o_orderstatus")
    lines = sinks.markdown("Orders", {"By status": by}).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "i int, line string")


# ---- joins, aggregations, sorts and state machines


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring suppliers as pairs of companies with their postings."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", (F.col("s_suppkey") * 7 % 5).alias("jobs"))
    b = s.select((F.col("s_suppkey") - 1).alias("a_id"), F.col("s_suppkey").alias("b_id"), F.col("s_name").alias("b_name"), F.col("jobs").alias("b_jobs"))
    return s.select(F.col("s_suppkey").alias("a_id"), F.col("s_name").alias("a_name"), F.col("jobs").alias("a_jobs")).join(b, "a_id").withColumn("similarity", F.round(0.5 + F.col("a_id") % 10 / 25, 4))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    note = F.to_json(F.struct(F.lit("x").alias("actor"), F.col("s_name").alias("alias_raw_name")))
    gone = s.where("s_suppkey % 4 = 0").select(F.lit("company_aliases").alias("table_name"), (F.col("s_suppkey") - 1).alias("record_id"), F.when(F.col("s_suppkey") % 8 == 0, "delete").otherwise("insert").alias("operation"), note.alias("old_data"))
    back = s.where("s_suppkey % 6 = 0").select(F.lit("company_aliases").alias("table_name"), (F.col("s_suppkey") + 1).alias("record_id"), F.lit("delete").alias("operation"), note.alias("old_data"))
    return gone.unionByName(back)


def join_anti_rejection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.without_rejected(_pairs(spark, sf_dir), _log(spark, sf_dir)).select("a_id", "b_id")


def sort_sim_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).orderBy(F.desc("similarity"), "a_id").limit(40).select("a_id", "b_id", "similarity")


def st_company_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals, a review that rejects some, and the next batch, which does not bring these back."""
    aliases = spark.createDataFrame([], "company_id long, raw_name string, match_confidence double")
    log = spark.createDataFrame([], "table_name string, record_id long, operation string, old_data string")
    pairs = _pairs(spark, sf_dir)
    aliases = store.propose(aliases, store.canonical_first(store.without_rejected(pairs, log)))
    aliases, log = store.reject(aliases, log, aliases.where("company_id % 3 = 0").select("company_id", "raw_name"))
    again = store.propose(aliases, store.canonical_first(store.without_rejected(pairs, log)))
    return again.select("company_id", "raw_name", "match_confidence")


def agg_array_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("company_id"), F.col("n_name").alias("company_name"), (F.col("n_nationkey") % 5 == 0).alias("is_verified"))
    a = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("company_id"), F.col("s_suppkey").alias("alias_id"), F.col("s_name").alias("raw_name"), F.round(F.col("s_suppkey") % 10 / 10, 1).alias("match_confidence"))
    g = store.alias_groups(c, a)
    return g.select("company_id", "company_name", *[F.array_join(F.col(x).cast("array<string>"), "|").alias(x) for x in ("alias_ids", "raw_names", "confidences")])


def st_cross_push(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders pushed into a store that holds some of them under ids of its own."""
    o = _orders(spark, sf_dir)
    here = o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("k"), "o_orderkey").alias("code"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status"), F.col("day").alias("first"), F.col("day").alias("last"), F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderkey")).alias("duplicate_of")).where("id % 2 = 0")
    there = o.where("o_orderkey % 4 = 0 OR o_orderkey % 7 = 0").select((F.col("o_orderkey") + 1_000_000).alias("id"), F.concat(F.lit("k"), "o_orderkey").alias("code"), F.lit("old").alias("status"), F.date_add("day", -2).alias("first"), F.date_add("day", 2).alias("last"), F.lit(None).cast("long").alias("duplicate_of"))
    out = store.push(here, there, ["code"], ["status"], "first", "last")
    return out.select("there_id", "code", "status", "first", "last", "duplicate_of", "change")


def mrg_upsert_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as postings: known, unchanged, changed and new ones, with pay and closing days that come and go."""
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("title"), F.col("o_orderpriority").alias("title_en"), F.col("day").alias("closing"), F.col("o_custkey").alias("digest"), F.col("day").alias("seen"),
                                      F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("low"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey") + 10).alias("high"))
    new = o.where("k % 4 = 0").select((F.col("k") + F.when(F.col("k") % 8 == 0, 0).otherwise(1)).alias("k"), F.lower("title").alias("title"), F.when(F.col("k") % 3 == 0, F.lower("title_en")).alias("title_en"), F.when(F.col("k") % 32 != 0, F.date_add("closing", 5)).alias("closing"),
                                      F.when(F.col("k") % 16 == 0, F.col("digest")).otherwise(F.col("digest") + 1).alias("digest"), F.date_add("seen", 1).alias("seen"), F.when(F.col("k") % 6 != 0, F.col("low") + F.col("k") % 3).alias("low"), F.col("high"))
    return store.save_postings(o.where("k % 4 <> 1"), new, "k", "digest", "seen", ["title"], ["title_en"], ["closing"], "low", "high")


def mrg_guard_shrink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sound merge passes; of four broken ones each is refused for its reason."""
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v"))
    whole = a.unionByName(b.join(a, "k", "left_anti"))
    tried = {"sound": whole, "key lost": whole.where("k <> 3"), "key twice": a.unionByName(b), "column lost": whole.drop("v"), "own column": whole.withColumn("rn", F.lit(1))}
    rows = []
    for name, merged in tried.items():
        try:
            rows.append((name, store.guarded(merged, [a, b], ["k"], ["k", "v"]).count() > 0, None))
        except ValueError as e:
            rows.append((name, False, str(e).split(":")[0] if "column" in name else "keys" if name == "key lost" else "repeated"))
    return spark.createDataFrame(rows, "merge string, passed boolean, reason string")


def q_site_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lists of sites merged by host, ranked by status, with their pages: the fifteen of most."""
    host = F.regexp_replace(F.lower(F.try_parse_url("url", F.lit("HOST"))), "^(www|m|blog)[.]", "")
    p = read(spark, sf_dir, "pages").select("page_id", host.alias("host")).where("host IS NOT NULL")
    listed, found = p.where("page_id % 3 <> 0").groupBy("host").agg(F.count("*").alias("a")), p.where("page_id % 3 = 0").groupBy("host").agg(F.count("*").alias("b"))
    both = listed.join(found, "host", "full_outer").select("host", F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "listed").otherwise("live").alias("status"), (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("rows"))
    rank = F.when(F.col("status") == "live", 0).when(F.col("status") == "listed", 1).otherwise(2)
    top = both.orderBy(F.desc("rows"), rank, "host").limit(15)
    kpi = F.broadcast(both.groupBy("status").agg(F.count("*").alias("sites")))  # three rows
    return top.join(kpi, "status").select("host", "status", "rows", "sites")


def fn_trgm_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", entity.similarity(F.col("p_name"), F.concat("p_name", F.lit(" "), "p_type")).alias("with_type"), entity.similarity(F.col("p_name"), F.lit("steel Widget")).alias("with_widget"))
    return p.select("p_partkey", F.round("with_type", 4).alias("with_type"), F.round("with_widget", 4).alias("with_widget"))


# ---- streams


def str_path_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").where("source IS NOT NULL")
    files = d.select("source", F.concat(F.lit("shards/source="), "source", F.lit("/part-"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.when(F.col("doc_id") % 9 == 0, ".tmp").otherwise(".parquet")).alias("path")).where("path IS NOT NULL")
    ledger = d.where("doc_id % 9 <> 0").groupBy("source").agg(F.concat(F.lit("shards/source="), F.first("source"), F.lit("/part-"), F.lpad(F.min("doc_id").cast("string"), 8, "0"), F.lit(".parquet")).alias("last_path")).where("source <> 'src1'")
    return store.in_fold_order(files, ledger, "path", "source", "last_path").where("place <= 5").select("source", "path", F.col("place").cast("int").alias("place"))


def str_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    ledger = spark.createDataFrame([("click", datetime.datetime(2024, 1, 1)), ("view", None), ("error", datetime.datetime(2024, 1, 1))], "event_type string, merged_at timestamp")
    now = e.agg(F.max("ts")).first()[0]
    return store.prunable(e, ledger, F.lit(now), 7, "ts", "event_type").select("event_id")


def str_unchanged_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of sightings in three files: each batch is upserted into the state table of users' last kind and time."""
    return incremental.touch_stream(spark, sf_dir)


def str_daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.daily_counts(spark, sf_dir)


def str_interval_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When runs start that are due every 12 hours, of ticks that come late: missed ones fall together, and one over an hour late is passed over."""
    ticks = [0, 12, 12.9, 25.5, 50, 60, 61.5, 73]
    return spark.createDataFrame([(float(t), s) for t, s in incremental.due(ticks, every=12.0, grace=1.0)], "hour double, state string")


FRAMES = {f.__name__: f for f in (
    src_parquet_shards, src_parquet_footer_count, src_partition_from_path, src_parquet_schema_check, set_schema_diff, src_overlay_parquet, src_table_scan, src_paged_scan, src_json_api, src_html_page, src_rss_xml, src_browser, src_retry, src_hf_retry, src_seed_lists,
    src_site_config, src_per_source, sink_shard_incremental, sink_snapshot_full, sink_state_snapshot, sink_state_restore, sink_copy_stage, sink_audit_append, sink_report_md, join_anti_rejection, sort_sim_desc, st_company_alias, agg_array_parallel, st_cross_push,
    mrg_upsert_job, mrg_guard_shrink, q_site_directory, fn_trgm_similarity, str_path_order, str_late_rows, str_unchanged_touch, str_daily_window, str_interval_trigger,
)}

_SHARD_ROWS = "(SELECT doc_id, n_chars, source, (DATE '2024-01-01' + (doc_id % 3)::INTEGER)::DATE AS dt FROM documents WHERE source IS NOT NULL)"
_PAIR_ROWS = """(SELECT a.s_suppkey AS a_id, a.s_name AS a_name, a.s_suppkey * 7 % 5 AS a_jobs, b.s_suppkey AS b_id, b.s_name AS b_name, b.s_suppkey * 7 % 5 AS b_jobs, round(0.5::DOUBLE + a.s_suppkey % 10 / 25::DOUBLE, 4) AS similarity
    FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1)"""
_TRGM = """list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substr('  ' || w || ' ', i, 3)))))"""

FRAMES_SQL = {
    "src_parquet_shards": f"SELECT source, dt, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM {_SHARD_ROWS} WHERE dt >= DATE '2024-01-02' GROUP BY ALL",
    "src_parquet_footer_count": "SELECT 2 * count(*) AS n FROM lineitem",
    "src_partition_from_path": "SELECT doc_id, source AS part FROM documents WHERE source IS NOT NULL",
    "src_parquet_schema_check": "SELECT 'title' AS column, 'missing' AS state UNION ALL SELECT column_name, 'extra' FROM (DESCRIBE documents) WHERE column_name NOT IN ('doc_id', 'text', 'lang')",
    "set_schema_diff": "SELECT column_name AS column, 'right' AS side FROM (DESCRIBE lineitem) UNION ALL SELECT column_name, 'left' FROM (DESCRIBE orders)",
    "src_overlay_parquet": """SELECT * FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN lang END AS title_en, CASE WHEN doc_id % 2 = 0 THEN source END AS language_code, NULL::VARCHAR AS description_en FROM documents)
        WHERE coalesce(title_en, '') <> '' OR coalesce(language_code, '') <> ''""",
    "src_table_scan": "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0",
    "src_paged_scan": "SELECT o_orderkey // 500 AS page, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1",
    "src_json_api": """SELECT event_id, ['ok', 'ok', 'permanent', 'transient', 'transient', 'transient', 'ok'][event_id % 7 + 1] AS outcome, CASE WHEN event_id % 7 < 2 THEN json_extract_string(props, '$.k')::BIGINT END AS k FROM events""",
    "src_html_page": "SELECT page_id, length(html) AS n_chars FROM pages WHERE page_id < 40 AND html IS NOT NULL",
    "src_rss_xml": "SELECT s_nationkey, s_name AS title, 'u?a=1&b=' || s_suppkey AS link FROM supplier",
    "src_browser": "SELECT page_id, CASE WHEN page_id % 4 IN (1, 2) OR page_id % 8 = 7 THEN 'challenge' WHEN page_id % 8 = 3 THEN 'empty' ELSE 'ok' END AS state FROM pages",
    "src_retry": "SELECT * FROM (VALUES (0, 1.0::DOUBLE, 7), (1, 2.0, 7)) t(i, seconds, value)",
    "src_hf_retry": "SELECT * FROM (VALUES (0, 3.0::DOUBLE, 7), (1, 6.0, 7), (2, 12.0, 7), (3, 24.0, 7), (4, 48.0, 7), (5, 90.0, 7)) t(i, seconds, value)",
    "src_seed_lists": "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 5 END AS level, count(*) AS n FROM orders GROUP BY 1",
    "src_site_config": "SELECT s_name AS source_code, 'https://x.test/' || s_suppkey AS base_url, 'a.' || s_nationkey AS job_link, NULL::VARCHAR AS listing_path, s_nationkey AS min_description_chars FROM supplier",
    "src_per_source": """SELECT event_id, 'even' AS source, 'job_id' AS field, event_id::VARCHAR AS value FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, 'even', 'value', json_extract_string(props, '$.k') FROM events WHERE event_id % 2 = 0
        UNION ALL SELECT event_id, 'odd', 'number', event_id::VARCHAR FROM events WHERE event_id % 2 = 1""",
    "sink_shard_incremental": "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS events, 2 AS stamps, max(ts) AS mark FROM events GROUP BY 1",
    "sink_snapshot_full": "SELECT source, count(*) AS n FROM documents WHERE doc_id % 2 = 0 AND source IS NOT NULL OR source NOT IN (SELECT source FROM documents WHERE source IN ('src0', 'src1') AND doc_id % 2 = 0) GROUP BY 1",
    "sink_state_snapshot": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _REFERENCES),
    "sink_state_restore": " UNION ALL ".join(f"SELECT {i} AS place, '{t}' AS name, count(*) AS n, max({k})::BIGINT + 1 AS next_id FROM {t}" for i, (t, k) in enumerate((("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")))),
    "sink_copy_stage": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'b' ELSE 'a' END AS title FROM orders WHERE o_orderkey % 5 = 0",
    "sink_audit_append": """SELECT 'supplier' AS table_name, s_suppkey AS record_id, CASE WHEN NOT was THEN 'insert' WHEN NOT now THEN 'delete' ELSE 'update' END AS operation, CASE WHEN was THEN s_nationkey::VARCHAR END AS was,
        CASE WHEN now THEN (s_nationkey + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END)::VARCHAR END AS now FROM (SELECT *, s_suppkey % 11 <> 0 AS was, s_suppkey % 7 <> 0 AS now FROM supplier) WHERE (was OR now) AND NOT (was AND now AND s_suppkey % 5 <> 0)""",
    "sink_report_md": """WITH b AS (SELECT row_number() OVER (ORDER BY o_orderstatus) AS r, '| ' || o_orderstatus || ' | ' || count(*) || ' |' AS line FROM orders GROUP BY o_orderstatus)
        SELECT i::INTEGER AS i, line FROM (VALUES (0, '# Orders'), (1, ''), (2, '## By status'), (3, ''), (4, '| o_orderstatus | n |'), (5, '| --- | --- |')) t(i, line) UNION ALL SELECT (5 + r)::INTEGER, line FROM b UNION ALL SELECT (6 + count(*))::INTEGER, '' FROM b""",
    "join_anti_rejection": f"SELECT a_id, b_id FROM {_PAIR_ROWS} WHERE NOT (b_id % 8 = 0) AND NOT (a_id % 6 = 0)",
    "sort_sim_desc": f"SELECT a_id, b_id, similarity FROM {_PAIR_ROWS} ORDER BY similarity DESC, a_id LIMIT 40",
    "st_company_alias": f"""SELECT CASE WHEN f THEN a_id ELSE b_id END AS company_id, CASE WHEN f THEN b_name ELSE a_name END AS raw_name, round(similarity, 2) AS match_confidence FROM (SELECT *, a_jobs >= b_jobs AS f FROM {_PAIR_ROWS})
        WHERE CASE WHEN f THEN a_id ELSE b_id END % 3 <> 0""",
    "agg_array_parallel": """SELECT n_nationkey AS company_id, n_name AS company_name, string_agg(s_suppkey::VARCHAR, '|' ORDER BY s_suppkey) AS alias_ids, string_agg(s_name, '|' ORDER BY s_suppkey) AS raw_names,
        string_agg(round(s_suppkey % 10 / 10::DOUBLE, 1)::VARCHAR, '|' ORDER BY s_suppkey) AS confidences FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0 GROUP BY 1, 2""",
    "st_cross_push": """WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderdate::DATE AS day, o_orderkey % 2 = 0 AS h, o_orderkey % 4 = 0 OR o_orderkey % 7 = 0 AS t FROM orders),
        i AS (SELECT *, CASE WHEN t THEN k + 1000000 ELSE (SELECT max(k) + 1000000 FROM o WHERE t) + row_number() OVER (PARTITION BY t ORDER BY k) END AS id FROM o WHERE h OR t AND NOT h)
        SELECT id AS there_id, 'k' || k AS code, CASE WHEN h AND k % 3 <> 0 THEN s WHEN t THEN 'old' END AS status, CASE WHEN t THEN (day - 2)::DATE ELSE day END AS first, CASE WHEN t THEN (day + 2)::DATE ELSE day END AS last,
        CASE WHEN h AND k % 5 = 0 THEN id END AS duplicate_of, CASE WHEN NOT h THEN 'kept' WHEN t THEN 'updated' ELSE 'inserted' END AS change FROM i""",
    "mrg_upsert_job": """WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS title, o_orderpriority AS title_en, o_orderdate::DATE AS closing, o_custkey AS digest, o_orderdate::DATE AS seen, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS low, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey + 10 END AS high FROM orders),
        o AS (SELECT * FROM a WHERE k % 4 <> 1), n AS (SELECT k + CASE WHEN k % 8 = 0 THEN 0 ELSE 1 END AS k, lower(title) AS title, CASE WHEN k % 3 = 0 THEN lower(title_en) END AS title_en, CASE WHEN k % 32 <> 0 THEN (closing + 5)::DATE END AS closing,
          CASE WHEN k % 16 = 0 THEN digest ELSE digest + 1 END AS digest, (seen + 1)::DATE AS seen, CASE WHEN k % 6 <> 0 THEN low + k % 3 END AS low, high FROM a WHERE k % 4 = 0),
        j AS (SELECT coalesce(o.k, n.k) AS k, o AS w, n AS m, CASE WHEN n.k IS NULL THEN 'kept' WHEN o.k IS NULL THEN 'inserted' WHEN o.digest IS NOT DISTINCT FROM n.digest THEN 'unchanged' ELSE 'updated' END AS change FROM o FULL OUTER JOIN n ON o.k = n.k)
        SELECT k, CASE WHEN change IN ('inserted', 'updated') THEN m.title ELSE w.title END AS title, CASE WHEN change IN ('inserted', 'updated') THEN m.low ELSE w.low END AS low, CASE WHEN change IN ('inserted', 'updated') THEN m.high ELSE w.high END AS high,
        CASE WHEN change IN ('inserted', 'updated') THEN m.digest ELSE w.digest END AS digest, coalesce(m.title_en, w.title_en) AS title_en, CASE WHEN change = 'kept' THEN w.closing ELSE m.closing END AS closing, greatest(w.seen, m.seen) AS seen, change,
        change = 'inserted' OR (change = 'updated' AND coalesce((w.low <> m.low OR w.high <> m.high) AND w.low IS NOT NULL AND w.high IS NOT NULL AND m.low IS NOT NULL AND m.high IS NOT NULL, false)) AS pay_history FROM j""",
    "mrg_guard_shrink": "SELECT * FROM (VALUES ('sound', true, NULL), ('key lost', false, 'keys'), ('key twice', false, 'repeated'), ('column lost', false, 'columns lost'), ('own column', false, 'columns of the merge''s own')) t(merge, passed, reason)",
    "q_site_directory": r"""WITH p AS (SELECT page_id, regexp_replace(lower(nullif(regexp_extract(url, '^[a-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')), '^(www|m|blog)[.]', '') AS host FROM pages),
        b AS (SELECT host, CASE WHEN count(*) FILTER (WHERE page_id % 3 <> 0) = 0 THEN 'new' WHEN count(*) FILTER (WHERE page_id % 3 = 0) = 0 THEN 'listed' ELSE 'live' END AS status, count(*) AS rows FROM p WHERE host IS NOT NULL GROUP BY host),
        t AS (SELECT * FROM b ORDER BY rows DESC, CASE status WHEN 'live' THEN 0 WHEN 'listed' THEN 1 ELSE 2 END, host LIMIT 15)
        SELECT host, t.status, rows, sites FROM t JOIN (SELECT status, count(*) AS sites FROM b GROUP BY status) k ON k.status = t.status""",
    "fn_trgm_similarity": f"""WITH g AS (SELECT p_partkey, {_TRGM.format('p_name')} AS a, {_TRGM.format("(p_name || ' ' || p_type)")} AS b, {_TRGM.format("'steel Widget'")} AS c FROM part)
        SELECT p_partkey, round(len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))), 4) AS with_type, round(len(list_intersect(a, c))::DOUBLE / (len(a) + len(c) - len(list_intersect(a, c))), 4) AS with_widget FROM g""",
    "str_path_order": """WITH f AS (SELECT source, doc_id, 'shards/source=' || source || '/part-' || lpad(doc_id::VARCHAR, 8, '0') || '.parquet' AS path FROM documents WHERE source IS NOT NULL AND doc_id % 9 <> 0),
        l AS (SELECT source, min(doc_id) AS first FROM f WHERE source <> 'src1' GROUP BY source), r AS (SELECT f.source, path, row_number() OVER (PARTITION BY f.source ORDER BY CASE WHEN doc_id = first THEN 0 ELSE 1 END, path DESC) AS place FROM f LEFT JOIN l ON l.source = f.source)
        SELECT source, path, place::INTEGER AS place FROM r WHERE place <= 5""",
    "str_late_rows": "SELECT event_id FROM events WHERE event_type IN ('click', 'error') AND ts < (SELECT max(ts) FROM events) - INTERVAL '7' DAY",
    "str_unchanged_touch": "SELECT user_id, arg_max(event_type, (ts, event_type)) AS kind, max(ts) AS seen FROM events GROUP BY 1",
    "str_daily_window": "SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1",
    "str_interval_trigger": "SELECT * FROM (VALUES (0.0::DOUBLE, 'run'), (12.0, 'run'), (12.9, 'not due'), (25.5, 'too late'), (50.0, 'too late'), (60.0, 'run'), (61.5, 'not due'), (73.0, 'run')) t(hour, state)",
}


def queries() -> dict:
    return FRAMES


def oracle_sql() -> dict[str, str]:
    return FRAMES_SQL
