"""Incremental export and exactly-once merging as Structured Streaming over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.tables import read, work_dir


def run_available(spark: SparkSession, source: str, schema, root: str, transform) -> DataFrame:
    """Merge the files of `source` not merged yet into root/out and return it; the checkpoint is the ledger of files done."""
    stream = spark.readStream.schema(schema).parquet(source)
    q = transform(stream).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ledger").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same shards: the second finds nothing new, so counts are those of one."""
    root = work_dir(spark, "stream")
    events = read(spark, sf_dir, "events")
    events.write.parquet(f"{root}/shards")
    for _ in range(2):
        out = run_available(spark, f"{root}/shards", events.schema, root, lambda s: s.select("event_id", "event_type"))
    return out.groupBy("event_type").agg(F.count("*").alias("n"))


def watermark_export(spark: SparkSession, sf_dir: str, since: str = "2024-01-03 00:00:00") -> DataFrame:
    """Two exports under one state: up to `since`, and what is newer than the marks that the first left, which is returned from its files."""
    from siltstone.sinks import files

    root = work_dir(spark, "export")
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.lit("all").alias("source"))
    files.export_newer(events.where(F.col("ts") <= F.lit(since).cast("timestamp_ntz")), f"{root}/shards", f"{root}/state", "source", "ts", "1")
    files.export_newer(events, f"{root}/shards", f"{root}/state", "source", "ts", "2")
    return spark.read.schema("event_id long, user_id long").parquet(f"{root}/shards/stamp=2").select("event_id", "user_id")


def touch_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings that arrive file by file, each batch merged into the state of users' last kind and time.

    Each batch writes a version of the state under its own number, so a batch
    that runs again writes the same version again.
    """
    from siltstone.operators.store import touched

    root = work_dir(spark, "touch")
    events = read(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("kind"), F.col("ts").alias("seen"))
    events.repartition(3).write.parquet(f"{root}/in")
    schema, last = events.schema, {}

    def merge(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        state = own.read.schema(schema).parquet(f"{root}/state/{number - 1}") if number else own.createDataFrame([], schema)
        touched(state, batch, "user_id", "kind", "seen").write.mode("overwrite").parquet(f"{root}/state/{number}")
        last["number"] = number

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/ledger").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/state/{last['number']}") if last else spark.createDataFrame([], schema)


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows of a day over a stream, kept open for rows up to seven days late; each batch writes the counts so far."""
    root = work_dir(spark, "daily")
    # the table's times carry no zone: they count as UTC, and so do the days
    zone = F.current_timezone()
    events = read(spark, sf_dir, "events").select("event_id", F.from_utc_timestamp(F.col("ts").cast("timestamp"), zone).alias("ts"))
    # in order of time, so that no row is later than the watermark allows
    events.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{root}/in")
    last = {}

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/{number}")
        last["number"] = number

    stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
    counts = stream.withWatermark("ts", "7 days").groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n")).select(F.to_utc_timestamp("window.start", zone).cast("date").alias("day"), "n")
    counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{root}/ledger").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("day date, n long").parquet(f"{root}/out/{last['number']}") if last else spark.createDataFrame([], "day date, n long")


def due(ticks: list[float], every: float, grace: float) -> list[tuple[float, str]]:
    """What a scheduler does at each tick: run, where a point of the schedule has passed since the last one, missed ones falling together; too late, where that point lies more than `grace` back; else not due."""
    out, following = [], 0.0
    for t in ticks:
        point = t // every * every
        if t < following:
            out.append((t, "not due"))
            continue
        out.append((t, "run" if t - point <= grace else "too late"))
        following = point + every
    return out
