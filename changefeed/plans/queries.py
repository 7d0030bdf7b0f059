"""The engine's queries over the ``events`` table, by name.

Each takes a session and the folder of the tables and returns a DataFrame.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import TimestampType

from changefeed.config import Settings, is_local, prepare_session, work_dir
from changefeed.functions import storage
from changefeed.operators import (
    compaction,
    compare,
    exports,
    incremental,
    percentiles,
    quality,
    rebuild,
    seen,
    sketches,
    upkeep,
    windows,
)
from changefeed.operators.dedup import collapse_batches, first_copies
from changefeed.operators.gate import envelope, gate, judged
from changefeed.operators.writes import write_partitioned
from changefeed.schema import ALL_TABLES, BRONZE, BOTS, DAY, EDITS, LATE, PAGES, REJECTS, Table, create_tables
from changefeed.sources.captured import intake, read_captured
from changefeed.sources.events import change_log, read_events, stream_events
from changefeed.sources.log import LogSource, feed_key, keyed, land, land_by_feed, rows_per_partition, widened
from changefeed.sources.tables import between, read_files, read_live, read_table, listed_tables
from changefeed.streaming import metrics, ranking, silence, state
from changefeed.streaming.handover import first_load
from changefeed.streaming.pipeline import Pipeline
from changefeed.streaming.sinks import overwrite_batches

Query = Callable[[SparkSession, str], DataFrame]


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as the source has them, in UTC and without a zone."""
    times = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, TimestampType)
    }
    return df.withColumns(times) if times else df


def _width(spark: SparkSession) -> int:
    """The table has few splits and its records are costly to parse."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def raw_log(spark: SparkSession, directory: str) -> DataFrame:
    return change_log(widened(read_events(prepare_session(spark), directory), _width(spark)))


def streamed_log(spark: SparkSession, directory: str) -> DataFrame:
    stream = stream_events(prepare_session(spark), directory)
    return change_log(widened(stream, _width(spark)))


def accepted(spark: SparkSession, directory: str) -> DataFrame:
    return gate(raw_log(spark, directory))[0]


def rejected(spark: SparkSession, directory: str) -> DataFrame:
    return gate(raw_log(spark, directory))[1]


def events(spark: SparkSession, directory: str) -> DataFrame:
    """Accepted events, each id once."""
    return first_copies(accepted(spark, directory))


FACTS = [c for c in BRONZE.column_names if c != "raw_json"]


# --- gate ---------------------------------------------------------------

def gate_accepted(spark: SparkSession, directory: str) -> DataFrame:
    return accepted(spark, directory)


def gate_rejected_by_reason(spark: SparkSession, directory: str) -> DataFrame:
    return rejected(spark, directory).groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def gate_matched_by_reason(spark: SparkSession, directory: str) -> DataFrame:
    refused = gate(raw_log(spark, directory), strings="matched")[1]
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def reject_envelope(spark: SparkSession, directory: str) -> DataFrame:
    return envelope(rejected(spark, directory))


def feed_partition_counts(spark: SparkSession, directory: str) -> DataFrame:
    log = raw_log(spark, directory).select(feed_key().alias("feed"))
    return log.groupBy("feed").agg(F.count(F.lit(1)).alias("row_count"))


# --- batch tables -------------------------------------------------------

def dedup_events(spark: SparkSession, directory: str) -> DataFrame:
    return events(spark, directory).select(*FACTS)


def edits_per_minute(spark: SparkSession, directory: str) -> DataFrame:
    return windows.EDITS_SPEC.build(events(spark, directory))


def bot_vs_human_per_minute(spark: SparkSession, directory: str) -> DataFrame:
    return windows.BOTS_SPEC.build(events(spark, directory))


def page_edits_10min(spark: SparkSession, directory: str) -> DataFrame:
    return windows.PAGES_SPEC.build(events(spark, directory))


def late_per_minute(spark: SparkSession, directory: str) -> DataFrame:
    return windows.LATE_SPEC.build(events(spark, directory))


def top_pages_10min(spark: SparkSession, directory: str) -> DataFrame:
    return windows.top_pages(page_edits_10min(spark, directory), 3)


def top_pages_daily(spark: SparkSession, directory: str) -> DataFrame:
    pages = windows.PAGES_SPEC.build(events(spark, directory), length="1 day")
    return windows.top_pages(pages, 5)


def bot_share(spark: SparkSession, directory: str) -> DataFrame:
    return windows.bot_share(bot_vs_human_per_minute(spark, directory))


def predicate_share(spark: SparkSession, directory: str) -> DataFrame:
    return windows.predicate_share(
        events(spark, directory), F.col("type") == "error", "1 day", ["wiki"]
    )


def skew_percentiles(spark: SparkSession, directory: str) -> DataFrame:
    return percentiles.exact_percentiles(
        events(spark, directory), percentiles.ingest_skew(), "wiki"
    )


def skew_percentiles_approx(spark: SparkSession, directory: str) -> DataFrame:
    """Is the share of values below or at the sketch's answer within 0.1 % of
    the wanted one? Ties may carry the share past it; then the share strictly
    below must not."""
    found = events(spark, directory).select("wiki", percentiles.ingest_skew().alias("skew"))
    marks = percentiles.approximate_percentiles(found, F.col("skew"), "wiki")
    held = found.groupBy("wiki", "skew").agg(F.count(F.lit(1)).alias("n"))
    below, upto = F.sum(F.when(F.col("skew") < F.col("value"), F.col("n"))), F.sum(F.when(F.col("skew") <= F.col("value"), F.col("n")))
    shares = marks.join(held, "wiki").groupBy("wiki", "point").agg(
        (F.coalesce(below, F.lit(0)) / F.sum("n")).alias("below"), (F.coalesce(upto, F.lit(0)) / F.sum("n")).alias("upto")
    )
    within = (F.col("below") <= F.col("point") + 0.001) & (F.col("upto") >= F.col("point") - 0.001)
    return shares.select("wiki", "point", within.alias("within_bound"))


# --- quality ------------------------------------------------------------

def _written_bronze(spark: SparkSession, directory: str, label: str) -> DataFrame:
    """Bronze written once, so that several queries share one parse."""
    path = work_dir(spark, label)
    events(spark, directory).select(*FACTS).write.parquet(path)
    return spark.read.parquet(path)


def table_counts(spark: SparkSession, directory: str) -> DataFrame:
    bronze = _written_bronze(spark, directory, "counts")
    gold = rebuild.gold_frames(bronze)
    return quality.table_counts({BRONZE.name: bronze, **gold})


def gold_total(spark: SparkSession, directory: str) -> DataFrame:
    bronze = _written_bronze(spark, directory, "gold-total")
    gold = rebuild.gold_frames(bronze)
    return quality.total_rows(quality.table_counts(gold), list(gold))


def table_growth(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze and reject counts sampled at the end of each day."""
    records = judged(raw_log(spark, directory))
    daily = records.groupBy(
        F.when(F.col("rejected"), "rejects").otherwise("bronze").alias("table_name"),
        F.to_date("ingested_at").alias("day"),
    ).agg(F.count(F.lit(1)).alias("n"))
    samples = daily.select(
        "table_name",
        F.date_add("day", 1).cast("timestamp").alias("sampled_at"),
        F.expr("sum(n) OVER (PARTITION BY table_name ORDER BY day)").alias("row_count"),
    )
    return quality.growth(samples)


def minimum_volume(spark: SparkSession, directory: str) -> DataFrame:
    return quality.minimum_volume(raw_log(spark, directory), 100)


def duplicate_check(spark: SparkSession, directory: str) -> DataFrame:
    before, after = accepted(spark, directory), events(spark, directory)
    return (
        quality.duplicate_check(before).select(F.lit("accepted").alias("table_name"), "*")
    ).unionByName(quality.duplicate_check(after).select(F.lit("bronze").alias("table_name"), "*"))


def duplicated_keys(spark: SparkSession, directory: str) -> DataFrame:
    return quality.duplicated_keys(accepted(spark, directory))


def residual_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    """With the page title as key: pages that come back after the horizon."""
    return quality.residual_duplicates(events(spark, directory), "2 minutes", key="title")


def freshness(spark: SparkSession, directory: str) -> DataFrame:
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return quality.freshness(accepted(spark, directory), now, 120)


def freshness_no_events(spark: SparkSession, directory: str) -> DataFrame:
    """A feed that has sent nothing since a year after the table ends."""
    now = F.lit("2025-01-31 00:00:00").cast("timestamp")
    recent = accepted(spark, directory).filter(F.col("event_time") >= F.lit("2025-01-01").cast("timestamp"))
    return quality.freshness(recent, now, 120)


def dedup_differing_copies(spark: SparkSession, directory: str) -> DataFrame:
    """Every id with a copy from 20 minutes earlier next to it in its batch:
    what the collapse before a stream's shuffle leaves of them."""
    facts = events(spark, directory).select("meta_id", "event_time")
    old = facts.withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 20 MINUTES"))
    both = old.unionByName(facts).repartition("meta_id")
    return collapse_batches(both).groupBy("meta_id").agg(F.max("event_time").alias("event_time"))


def _daily_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of bronze and of the gold counts at the end of each day."""
    found = events(spark, directory)
    daily = found.groupBy(F.to_date("event_time").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    parts = [daily.select(F.lit(BRONZE.name).alias("table_name"), "day", "n")]
    for spec in (windows.EDITS_SPEC, windows.BOTS_SPEC):
        gold = spec.build(found).groupBy(F.to_date("window_start").alias("day")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(gold.select(F.lit(spec.table.name).alias("table_name"), "day", "n"))
    return reduce(DataFrame.unionByName, parts).select(
        "table_name",
        F.date_add("day", 1).cast("timestamp").alias("sampled_at"),
        F.expr("sum(n) OVER (PARTITION BY table_name ORDER BY day)").alias("row_count"),
    )


def pipeline_verdict(spark: SparkSession, directory: str) -> DataFrame:
    """The daily verdict at the end of the table: one row."""
    found = events(spark, directory)
    fresh = quality.freshness(found, F.lit("2024-01-31 00:00:00").cast("timestamp"), 86_400)
    duplicates = quality.duplicate_check(found)
    return quality.pipeline_verdict(
        _daily_counts(spark, directory), fresh, duplicates, BRONZE.name, [EDITS.name, BOTS.name]
    )


def event_rate(spark: SparkSession, directory: str) -> DataFrame:
    return windows.rate(raw_log(spark, directory), "arrived_at", 60)


def reject_rate(spark: SparkSession, directory: str) -> DataFrame:
    return windows.rate(rejected(spark, directory), "ingested_at", 300)


def late_rate(spark: SparkSession, directory: str) -> DataFrame:
    late = events(spark, directory).filter(windows.is_late())
    return windows.rate(late, "ingested_at", 300)


def reject_share(spark: SparkSession, directory: str) -> DataFrame:
    records = judged(raw_log(spark, directory))
    return quality.reject_share(records, limit=0.1, length="1 hour")


def schema_drift(spark: SparkSession, directory: str) -> DataFrame:
    return quality.schema_drift(spark, raw_log(spark, directory), F.to_date("arrived_at"))


# --- tables, upkeep, exports --------------------------------------------

def rebuild_gold(spark: SparkSession, directory: str) -> DataFrame:
    """Page counts from bronze with other windows and another watermark."""
    bronze = _written_bronze(spark, directory, "rebuild-bronze")
    tables = rebuild.rebuild_gold(
        spark,
        bronze,
        work_dir(spark, "rebuild"),
        watermark="10 minutes",
        lengths={PAGES.name: "1 hour"},
    )
    return tables[PAGES.name]


def rebuilt_edits(spark: SparkSession, directory: str) -> DataFrame:
    """Per-minute counts summed up from those by bot flag."""
    bronze = _written_bronze(spark, directory, "rebuild-bronze")
    return rebuild.rebuild_gold(spark, bronze, work_dir(spark, "rebuild"))[EDITS.name]


def export_sample(spark: SparkSession, directory: str) -> DataFrame:
    path = work_dir(spark, "export")
    sample = exports.bronze_sample(events(spark, directory), 5_000)
    exports.export_parquet(sample, path)
    return spark.read.parquet(path).select(*FACTS)


def file_stats(spark: SparkSession, directory: str) -> DataFrame:
    path = work_dir(spark, "stats")
    write_partitioned(events(spark, directory), BRONZE, path)
    stats = upkeep.file_stats(read_files(spark, BRONZE, path), BRONZE.partitions)
    return stats.select(*BRONZE.partitions, "row_count", (F.col("byte_count") > 0).alias("has_bytes"))


def captured_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """The log as a captured event stream, read back and sorted into objects
    and refused data."""
    path = work_dir(spark, "captured")
    log = raw_log(spark, directory)
    block = F.concat(
        F.lit(": a comment\nid: "), F.crc32("raw_json").cast("string"), F.lit("\ndata: "), "raw_json", F.lit("\n")
    )
    log.select(block.alias("value")).write.text(path)
    objects, refused = intake(read_captured(spark, path))
    outcomes = objects.select(F.lit("object").alias("outcome")).unionByName(
        refused.select(F.lit("refused").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"))


def log_keyed(spark: SparkSession, directory: str) -> DataFrame:
    """Records per feed key: every feed in one log partition."""
    log = keyed(raw_log(spark, directory), 16)
    return log.groupBy("feed").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("log_partition").alias("partition_count")
    )


def log_landed(spark: SparkSession, directory: str) -> DataFrame:
    """The log landed as text files and read by the log source: accepted
    events, each id once. Blank records do not survive in text files."""
    path = work_dir(spark, "landed")
    land(raw_log(spark, directory), path, files=8)
    log = LogSource(format="text", path=path).read(spark, stream=False)
    return first_copies(gate(log)[0]).select(*FACTS)


def bronze_one_week(spark: SparkSession, directory: str) -> DataFrame:
    """Counts per day of a bounded scan of a partitioned table."""
    path = work_dir(spark, "week")
    write_partitioned(events(spark, directory), BRONZE, path)
    since, until = (datetime(2024, 1, d, tzinfo=timezone.utc) for d in (8, 15))
    week = between(read_files(spark, BRONZE, path), BRONZE, since, until)
    return week.groupBy(F.to_date("event_time").alias("event_day")).agg(F.count(F.lit(1)).alias("row_count"))


def sample_lines(spark: SparkSession, directory: str) -> DataFrame:
    """A sample of raw records written as lines: a limit that binds."""
    path = work_dir(spark, "lines")
    exports.export_json_lines(raw_log(spark, directory), path, 100)
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("row_count"))


def catalog_tables(spark: SparkSession, directory: str) -> DataFrame:
    """Names and sizes of the session's catalog tables over bronze and gold."""
    prepare_session(spark)
    name = f"feed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE NAMESPACE {name}")
    try:
        found = events(spark, directory).select(*FACTS)
        found.write.saveAsTable(f"{name}.{BRONZE.name}")
        windows.EDITS_SPEC.build(spark.table(f"{name}.{BRONZE.name}")).write.saveAsTable(f"{name}.{EDITS.name}")
        sizes = quality.table_counts({t: spark.table(f"{name}.{t}") for t in listed_tables(spark, name)})
        path = work_dir(spark, "catalog")
        sizes.write.parquet(path)
    finally:
        spark.sql(f"DROP NAMESPACE {name} CASCADE")
    return spark.read.parquet(path)


# --- streams ------------------------------------------------------------

def _settings(spark: SparkSession, label: str, **changes) -> Settings:
    """Settings of a pipeline in a folder of its own.

    A cluster wants the width of the state said: a partition per core, as a
    local session has, and no more than the session's shuffles. Executors may
    still be on their way when it is asked for, so a few count as there. The
    days and feeds of the table are many keys by themselves, so a few tasks to
    each are enough at any width.
    """
    if not is_local(spark):
        width = min(_width(spark), max(spark.sparkContext.defaultParallelism, 12))
        changes = {"state_partitions": width, "splits": min(8, max(2, width // 4)), **changes}
    return Settings(root=work_dir(spark, label), **changes)


def _pipeline(spark: SparkSession, directory: str, label: str, **changes) -> Pipeline:
    return Pipeline(spark, streamed_log(spark, directory), _settings(spark, label, **changes))


def _run(pipeline: Pipeline, *tables: Table) -> Pipeline:
    for query in pipeline.start(*tables, available_now=True):
        query.awaitTermination()
    return pipeline


def _from_log(table: Table) -> Query:
    """One streaming query from the log to a table."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        pipeline = _pipeline(spark, directory, f"stream-{table.name}", gold_from="source")
        return _run(pipeline, table).table(table)

    return query


def stream_bronze(spark: SparkSession, directory: str) -> DataFrame:
    return _from_log(BRONZE)(spark, directory).select(*FACTS)


def stream_rejects(spark: SparkSession, directory: str) -> DataFrame:
    return _from_log(REJECTS)(spark, directory)


def stream_pipeline_counts(spark: SparkSession, directory: str) -> DataFrame:
    """All six queries, gold from bronze: rows per table as the queries report
    them while they run, next to the rows that are there."""
    pipeline = _pipeline(spark, directory, "pipeline")
    tables = (BRONZE, EDITS, BOTS, PAGES, LATE, REJECTS)
    recorded = metrics.recorded(spark, pipeline.settings.metrics_path, pipeline.run_available)
    counts = quality.table_counts({t.name: pipeline.table(t) for t in tables})
    reported = metrics.rows_per_table(recorded).select(
        F.col("query").alias("table_name"), F.col("rows_written").alias("rows_reported")
    )
    return counts.join(reported, "table_name", "left")


def stream_metrics(spark: SparkSession, directory: str) -> DataFrame:
    """What the recorded metrics of a bronze run say: rows, newest event,
    freshness at the end of the month, and that batches took time."""
    pipeline = _pipeline(spark, directory, "metrics")
    recorded = metrics.recorded(spark, pipeline.settings.metrics_path, lambda: _run(pipeline, BRONZE))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    fresh = metrics.stream_freshness(recorded, BRONZE.name, now, 86_400)
    rows = metrics.rows_per_table(recorded).select("rows_written", "dropped_rows")
    took = metrics.last_duration(recorded).select((F.col("duration_seconds") > 0).alias("timed"))
    return (
        fresh.withColumn("rows_written", rows.select("rows_written").scalar())
        .withColumn("dropped_rows", rows.select("dropped_rows").scalar())
        .withColumn("timed", took.scalar())
    )


def _sliced_log(spark: SparkSession, log: DataFrame, later: Column, slices: int, files: int = 4) -> DataFrame:
    """The log by thirds of the month as text files, ``later`` slices after
    their own, and read as a stream with a batch for each slice."""
    begun = F.when(F.col("arrived_at") < F.lit("2024-01-11").cast("timestamp"), 0)
    begun = begun.when(F.col("arrived_at") < F.lit("2024-01-21").cast("timestamp"), 1).otherwise(2)
    path, parts = work_dir(spark, "sliced-log"), work_dir(spark, "slices")
    log.withColumn("slice", begun + later).write.partitionBy("slice").parquet(parts)
    for k in range(slices):
        own = spark.read.parquet(parts).filter(F.col("slice") == k)
        own.select("raw_json").repartition(files).write.mode("append").text(path)
    return LogSource(format="text", path=path, max_files=files).read(spark)


def stream_batches(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze over five batches of the log, second copies two batches late:
    lateness goes by the watermark of the batch before, which drops them."""
    log = raw_log(spark, directory)
    again = F.row_number().over(Window.partitionBy("raw_json").orderBy("arrived_at")) - 1
    late = F.when(F.col("raw_json").contains('"id":"evt-'), 2 * again).otherwise(0)
    settings = _settings(spark, "batches")
    pipeline = Pipeline(spark, _sliced_log(spark, log, late, 5), settings)
    recorded = metrics.recorded(spark, settings.metrics_path, lambda: _run(pipeline, BRONZE))
    bronze = pipeline.table(BRONZE).agg(F.count(F.lit(1)).alias("bronze_rows"))
    told = recorded.agg(F.count_if(F.col("input_rows") > 0).alias("b"), F.sum("dropped_rows").alias("d"))
    return bronze.withColumn("data_batches", told.select("b").scalar()).withColumn("dropped_rows", told.select("d").scalar())


def rebuild_recovers_late(spark: SparkSession, directory: str) -> DataFrame:
    """Per-minute counts from a bronze that keeps everything, with events that
    came many days late: the stream's gold tables cannot have them, a rebuild has."""
    number = F.expr("try_cast(regexp_extract(raw_json, '\"id\":\"evt-([0-9]+)\"', 1) AS BIGINT)")
    late = F.when(number % 97 == 5, 2).otherwise(0)
    settings = _settings(spark, "keeps-all", bronze="all")
    pipeline = Pipeline(spark, _sliced_log(spark, raw_log(spark, directory), late, 5), settings)
    bronze = _run(pipeline, BRONZE).table(BRONZE)
    return windows.EDITS_SPEC.build(first_copies(bronze.select(*FACTS)))


def load_then_stream(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze loaded in batch for two thirds of the month and taken over by the
    stream, second copies near the boundary arriving after it."""
    log = raw_log(spark, directory)
    again = F.row_number().over(Window.partitionBy("raw_json").orderBy("arrived_at")) == 2
    near = F.col("arrived_at").between(F.lit("2024-01-20 22:00:00").cast("timestamp"), F.lit("2024-01-21").cast("timestamp"))
    path, parts = work_dir(spark, "handed-over"), work_dir(spark, "handed-over-parts")
    later = (F.col("arrived_at") >= F.lit("2024-01-21").cast("timestamp")) | (near & again)
    log.withColumn("slice", later.cast("int")).write.partitionBy("slice").parquet(parts)
    settings = _settings(spark, "load-then-stream", horizon="3 hours")
    source = LogSource(format="text", path=path, max_files=2)
    for k in range(2):
        spark.read.parquet(parts).filter(F.col("slice") == k).select("raw_json").repartition(4).write.mode("append").text(path)
        if k == 0:
            first_load(spark, settings, source)
    pipeline = Pipeline(spark, source.read(spark), settings)
    return _run(pipeline, BRONZE).table(BRONZE).select(*FACTS)


def stream_sessions(spark: SparkSession, directory: str) -> DataFrame:
    """Sessions of users over three batches: those whose end the watermark has
    passed, merged across batches."""
    settings = _settings(spark, "sessions")
    pipeline = Pipeline(spark, _sliced_log(spark, raw_log(spark, directory), F.lit(0), 3), settings)
    found = windows.sessions(pipeline.events("10 minutes", ["meta_id", "event_time", "user"]), "30 minutes", ["user"])
    out = work_dir(spark, "sessions-out")
    _streamed(spark, found, out, settings, "sessions")
    return spark.read.schema(found.schema).parquet(out)


def _streamed(spark: SparkSession, frame: DataFrame, out: str, settings: Settings, name: str) -> None:
    """Append what the log holds to Parquet files, with the pipeline's state width."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", settings.width(spark))
    try:
        writer = frame.writeStream.outputMode("append").option("checkpointLocation", settings.checkpoint(name))
        writer.trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def state_rows(spark: SparkSession, directory: str) -> DataFrame:
    """The ids that deduplication with a horizon of a day still keeps at the
    end of the table, read from the checkpoint."""
    pipeline = _run(_pipeline(spark, directory, "state", horizon="1 day"), BRONZE)
    return state.kept_ids(spark, pipeline.settings, BRONZE.name)


def stream_top_pages(spark: SparkSession, directory: str) -> DataFrame:
    """The three busiest pages of each window so far, kept over five batches,
    the last of them merged twice."""
    number = F.expr("try_cast(regexp_extract(raw_json, '\"id\":\"evt-([0-9]+)\"', 1) AS BIGINT)")
    late = F.when(number % 89 == 7, 2).otherwise(0)
    settings = _settings(spark, "ranking", horizon="40 days", watermark="40 days")
    pipeline = Pipeline(spark, _sliced_log(spark, raw_log(spark, directory), late, 5), settings)
    counts = windows.PAGES_SPEC.build(pipeline.events("40 days", windows.PAGES_SPEC.inputs))
    path = work_dir(spark, "ranking-table")
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", settings.width(spark))
    try:
        query = ranking.stream_ranking(counts, path, settings, 3, available_now=True)
        query.awaitTermination()
        storage.delete(spark, f"{settings.checkpoint('top-pages')}/commits/{max(p.batchId for p in query.recentProgress)}")
        ranking.stream_ranking(counts, path, settings, 3, available_now=True).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    return ranking.read_ranking(spark, path)


def silent_feeds(spark: SparkSession, directory: str) -> DataFrame:
    """One feed sends nothing after the first third of the month, the others go
    on: whether each is silent at the end, by timers that need no input."""
    path, parts = work_dir(spark, "silence-log"), work_dir(spark, "silence-parts")
    log = raw_log(spark, directory)
    third = F.when(F.col("arrived_at") < F.lit("2024-01-11").cast("timestamp"), 0).otherwise(1)
    log.withColumn("slice", third).filter((third == 0) | (feed_key() != "wiki3")).write.partitionBy("slice").parquet(parts)

    def add(k: int, share: int) -> None:
        some = spark.read.parquet(parts).filter((F.col("slice") == k) & (F.pmod(F.xxhash64("raw_json"), F.lit(4)) == share))
        some.select("raw_json").coalesce(1).write.mode("append").text(path)

    storage.make_folder(spark, path)
    out, settings = work_dir(spark, "silence"), _settings(spark, "silence-root")
    found = silence.silent_feeds(gate(LogSource(format="text", path=path).read(spark))[0], 15)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", settings.width(spark))
    try:
        writer = found.writeStream.outputMode("append").option("checkpointLocation", settings.checkpoint("silence"))
        query = writer.trigger(processingTime="1 second").format("parquet").start(out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    told = spark.read.schema(silence.SILENCE_DDL)
    last = lambda: told.parquet(out).groupBy("feed").agg(F.max_by("silent", "at").alias("silent"))
    try:
        for share in range(4):
            add(0, share)
        # The others send now and then until the timer of the silent one has run out; one that a
        # slow batch made late is silent until its next event. Timers keep batches coming, so
        # there is no end of the input to wait for.
        for step in range(40):
            add(1, step % 4)
            time.sleep(3)
            if [r.feed for r in last().filter("silent").collect()] == ["wiki3"]:
                break
        found = last().collect()
    finally:
        query.stop()
    ended = spark.createDataFrame(found, "feed string, silent boolean")
    feeds = accepted(spark, directory).select(F.col("wiki").alias("feed")).distinct()
    return feeds.join(ended, "feed", "left").select("feed", F.coalesce("silent", F.lit(False)).alias("silent"))


def stream_batches_overwritten(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze through the repeatable batch sink."""
    pipeline = _pipeline(spark, directory, "batches")
    path = work_dir(spark, "batches-out")
    overwrite_batches(pipeline.frame(BRONZE), path, pipeline.settings, "batches", available_now=True).awaitTermination()
    return spark.read.parquet(path).select(*FACTS)


def _from_bronze(table: Table) -> Query:
    """The default form: bronze first, then the gold query that reads it."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        pipeline = _run(_pipeline(spark, directory, f"bronze-{table.name}"), BRONZE)
        return _run(pipeline, table).table(table)

    return query


def replay_equals_control(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze after a forced replay of its last batches against the batch result."""
    pipeline = _run(_pipeline(spark, directory, "replay"), BRONZE)
    commits = f"{pipeline.settings.checkpoint(BRONZE.name)}/commits"
    last = max(p.batchId for p in pipeline.queries[BRONZE.name].recentProgress)
    storage.delete(spark, f"{commits}/{last}")
    again = Pipeline(spark, streamed_log(spark, directory), pipeline.settings)
    bronze = _run(again, BRONZE).table(BRONZE)
    return compare.same_rows(bronze, events(spark, directory), FACTS)


def compaction_equality(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze before and after compaction of the days up to the 20th."""
    pipeline = _run(_pipeline(spark, directory, "compact", splits=0), BRONZE)
    before = read_live(spark, pipeline.settings, BRONZE).select(*BRONZE.column_names)
    compaction.compact(spark, pipeline.settings, BRONZE, datetime(2024, 1, 20).date())
    return compare.same_rows(read_table(spark, pipeline.settings, BRONZE), before)


def _number() -> Column:
    """The number in an event's id."""
    return F.regexp_extract("meta_id", "([0-9]+)$", 1).cast("long")


def compaction_of_late_files(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze after a copy of closed days, late files for them in the same
    second, a second copy and a merge: every row once, whatever the clock says."""
    settings = Settings(root=work_dir(spark, "late-files"))
    path, through = settings.table_path(BRONZE.namespace, BRONZE.name), datetime(2024, 1, 20).date()
    found = _written_bronze(spark, directory, "late-source").withColumn("raw_json", F.lit(None).cast("string"))
    for k in range(3):
        write_partitioned(found.filter(_number() % 3 == k), BRONZE, path, mode="append")
        compaction.compact(spark, settings, BRONZE, through, full=k == 2)
        if k == 1:
            # Copied days next to files of the same days that no copy holds yet.
            write_partitioned(found.limit(0), BRONZE, path, mode="append")
    return read_table(spark, settings, BRONZE).select(*FACTS)


def _two_commits(spark: SparkSession, directory: str, label: str) -> tuple[Settings, list[DataFrame]]:
    """Bronze in two parts: the first three weeks but every 97th event, and the rest."""
    found = _written_bronze(spark, directory, label).withColumn("raw_json", F.lit(None).cast("string"))
    first = (F.col("event_time") < F.lit("2024-01-21").cast("timestamp")) & (_number() % 97 != 5)
    return Settings(root=work_dir(spark, label)), [found.filter(first), found.filter(~first)]


def rebuild_changed(spark: SparkSession, directory: str) -> DataFrame:
    """Per-minute counts kept up to date over two commits, the second with
    late events for old days: only the days and feeds it touches are recounted."""
    settings, parts = _two_commits(spark, directory, "changed")
    out = work_dir(spark, "changed-gold")
    for part in parts:
        write_partitioned(part, BRONZE, settings.table_path(BRONZE.namespace, BRONZE.name), mode="append")
        incremental.rebuild_changed(spark, settings, out, (windows.EDITS_SPEC,))
    return read_files(spark, EDITS, f"{out}/{EDITS.full_name}").select(*EDITS.column_names)


def rebuild_changed_days(spark: SparkSession, directory: str) -> DataFrame:
    """The days and feeds that the second commit makes the rebuild touch."""
    settings, parts = _two_commits(spark, directory, "changed-days")
    out = work_dir(spark, "changed-days-gold")
    for part in parts:
        write_partitioned(part, BRONZE, settings.table_path(BRONZE.namespace, BRONZE.name), mode="append")
        found = incremental.rebuild_changed(spark, settings, out, (windows.LATE_SPEC,))
    return found[LATE.name].select(DAY, BRONZE.feed).distinct()


def difference_levels(spark: SparkSession, directory: str) -> DataFrame:
    """A copy of bronze with lost and altered rows on three days, against the
    original: found by digests kept with both, day by day."""
    source = _written_bronze(spark, directory, "levels").withColumn("raw_json", F.sha2("title", 256))
    paths = [work_dir(spark, f"levels-{side}") for side in ("left", "right")]
    some = F.col("event_time").between(F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-12 23:59:59").cast("timestamp"))
    lost, altered = some & (_number() % 101 == 50), some & (_number() % 103 == 51)
    copy = source.filter(~lost).withColumn("raw_json", F.when(altered, F.lit("other")).otherwise(F.col("raw_json")))
    tables, kept = [], []
    for rows, path in zip((source, copy), paths, strict=True):
        write_partitioned(rows, BRONZE, path)
        tables.append(read_files(spark, BRONZE, path))
        compare.digests(tables[-1], DAY, "meta_id", BRONZE.column_names).write.parquet(f"{path}-digests")
        kept.append(spark.read.parquet(f"{path}-digests"))
    found = compare.difference_levels(*tables, *kept, DAY, "meta_id", BRONZE.column_names)
    return found.select("meta_id", "raw_json", F.col("surplus").cast("long").alias("surplus"))


def _stored_sketches(spark: SparkSession, directory: str) -> DataFrame:
    """One row for each day and feed."""
    path = work_dir(spark, "sketches")
    sketches.day_sketches(events(spark, directory), percentiles.ingest_skew(), "wiki").write.parquet(path)
    return spark.read.parquet(path)


def skew_from_sketches(spark: SparkSession, directory: str) -> DataFrame:
    """Percentiles from 30 merged days: are the ranks of the answers within the
    sketch's bound? Ties may carry a rank past it; then the one strictly below must not."""
    found = events(spark, directory).select("wiki", percentiles.ingest_skew().alias("skew"))
    merged = sketches.merged(_stored_sketches(spark, directory), ["wiki"])
    held = found.groupBy("wiki", "skew").agg(F.count(F.lit(1)).alias("n"))
    marks = sketches.percentiles_of(merged, ["wiki"])
    below, upto = F.sum(F.when(F.col("skew") < F.col("value"), F.col("n"))), F.sum(F.when(F.col("skew") <= F.col("value"), F.col("n")))
    shares = marks.join(held, "wiki").groupBy("wiki", "point", "event_count").agg(
        (F.coalesce(below, F.lit(0)) / F.sum("n")).alias("below"), (F.coalesce(upto, F.lit(0)) / F.sum("n")).alias("upto")
    )
    bound = sketches.rank_bound()
    within = (F.col("below") <= F.col("point") + bound) & (F.col("upto") >= F.col("point") - bound)
    return shares.select("wiki", "point", "event_count", within.alias("within_bound"))


def distinct_from_sketches(spark: SparkSession, directory: str) -> DataFrame:
    """Distinct ids of two weeks from merged sketches of days, within 3 percent of the count."""
    since, until = (datetime(2024, 1, d).date() for d in (8, 22))
    guess = sketches.distinct_of(sketches.merged(_stored_sketches(spark, directory), ["wiki"], since, until), ["wiki"])
    bounds = [F.lit(str(d)).cast("timestamp") for d in (since, until)]
    some = events(spark, directory).filter((F.col("event_time") >= bounds[0]) & (F.col("event_time") < bounds[1]))
    counts = some.groupBy("wiki").agg(F.count_distinct("meta_id").alias("event_count"))
    near = F.abs(F.col("distinct_keys") - F.col("event_count")) <= 0.03 * F.col("event_count") + 1
    return guess.join(counts, "wiki").select("wiki", "event_count", near.alias("within_bound"))


def residual_by_filter(spark: SparkSession, directory: str) -> DataFrame:
    """Users' pages of the last third of the month that earlier days have seen,
    and on which of them: filters of the days first, then the rows that may be."""
    path = work_dir(spark, "seen")
    page = F.concat_ws("/", "user", "title", "type", F.hour("event_time").cast("string"))
    events(spark, directory).select(page.alias("page"), F.to_date("event_time").alias("day")).write.parquet(path)
    found, begin = spark.read.parquet(path), F.lit("2024-01-21").cast("date")
    history, new = found.filter(F.col("day") < begin), found.filter(F.col("day") >= begin)
    kept = work_dir(spark, "seen-filters")
    seen.day_filters(history, "page", "day").write.partitionBy("day").parquet(kept)
    return seen.seen_before(new, history, spark.read.schema(seen.FILTER_DDL).parquet(kept), "page", "day")


def sessions_by_user(spark: SparkSession, directory: str) -> DataFrame:
    """Runs of a user's events with less than half an hour between them."""
    return windows.sessions(events(spark, directory), "30 minutes", ["user"])


def counts_from_footers(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of each day and feed of bronze, from the footers of its files."""
    path = work_dir(spark, "footers")
    write_partitioned(events(spark, directory), BRONZE, path)
    return quality.footer_counts(spark, path, BRONZE.stored_schema, BRONZE.partitions)


def rows_per_file(spark: SparkSession, directory: str) -> DataFrame:
    """Records in each file of a log that has a folder for each feed."""
    path = work_dir(spark, "log-files")
    land_by_feed(raw_log(spark, directory), path, files=_width(spark))
    source = LogSource(format="parquet", path=path, schema="raw_json string")
    found = rows_per_partition(source.load(spark, stream=False))
    feed = F.url_decode(F.regexp_extract("log_partition", "/feed=([^/]*)/", 1))
    return found.select(feed.alias("feed"), "row_count")


def log_tolerates_loss(spark: SparkSession, directory: str) -> DataFrame:
    """A log of three files one of which goes after it was listed: a tolerant
    source reads the rest, a strict one refuses."""
    path = work_dir(spark, "lossy")
    raw_log(spark, directory).repartition(3, "raw_json").select("raw_json").write.parquet(path)
    kept = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.crc32("raw_json").alias("h"))
    out = work_dir(spark, "lossy-rows")
    kept.write.parquet(out)
    kept = spark.read.parquet(out)
    gone = kept.agg(F.min("f")).first()[0]
    sources = [LogSource(format="parquet", path=path, schema="raw_json string", tolerate_loss=t) for t in (True, False)]
    frames = [source.read(spark, stream=False) for source in sources]
    storage.delete(spark, gone, encoded=True)
    rest = frames[0].agg(F.count(F.lit(1)).alias("n"), F.sum(F.crc32("raw_json")).alias("h"))
    try:
        frames[1].agg(F.sum(F.crc32("raw_json"))).collect()
        refused = False
    except Exception:
        refused = True
    wanted = kept.filter(F.col("f") != gone).agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h"))
    same = rest.unionByName(wanted).distinct().agg((F.count(F.lit(1)) == 1).alias("rest_read"))
    return same.withColumn("strict_refused", F.lit(refused))


def captured_contents(spark: SparkSession, directory: str) -> DataFrame:
    """The log as a captured event stream, read back through the gate: what the
    records say, and that each was stamped on the way in."""
    path = work_dir(spark, "captured-contents")
    block = F.concat(F.lit("id: "), F.crc32("raw_json").cast("string"), F.lit("\ndata: "), "raw_json", F.lit("\n"))
    raw_log(spark, directory).select(block.alias("value")).write.text(path)
    begun = F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp")
    objects = intake(read_captured(spark, path))[0]
    found = first_copies(gate(objects)[0])
    return found.select("meta_id", "event_time", "wiki", "type", "title", "user", "bot", (F.col("ingested_at") >= begun).alias("stamped"))


def created_tables(spark: SparkSession, directory: str) -> DataFrame:
    """Namespaces and tables made by the pipeline's own statements, twice, then
    filled through the catalog: columns, and rows by table."""
    prepare_session(spark)
    settings = Settings(root=work_dir(spark, "created"))
    found = _written_bronze(spark, directory, "created-source").withColumn("raw_json", F.lit(None).cast("string"))
    refused = _written_rejects(spark, directory)
    out, names = work_dir(spark, "created-counts"), [t.full_name for t in ALL_TABLES]
    held = {n for n in names if spark.catalog.tableExists(n)}
    try:
        create_tables(spark, settings)
        create_tables(spark, settings)
        rows = {BRONZE.name: found, REJECTS.name: refused, **rebuild.gold_frames(found)}
        for table in ALL_TABLES:
            write_partitioned(rows[table.name], table, settings.table_path(table.namespace, table.name))
            spark.catalog.recoverPartitions(table.full_name)
        counts = quality.table_counts({t.name: spark.table(t.full_name) for t in ALL_TABLES})
        columns = {t.name: len(spark.table(t.full_name).columns) for t in ALL_TABLES}
        width = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])
        counts.withColumn("column_count", F.element_at(width, F.col("table_name"))).write.parquet(out)
    finally:
        for name in names:
            if name not in held:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(out)


def _written_rejects(spark: SparkSession, directory: str) -> DataFrame:
    path = work_dir(spark, "rejects")
    rejected(spark, directory).write.parquet(path)
    return spark.read.parquet(path)


def orphan_files(spark: SparkSession, directory: str) -> DataFrame:
    """Files left by a failed writer, here a second copy of all of bronze that
    the sink's log does not know, and the table's own count."""
    pipeline = _run(_pipeline(spark, directory, "orphans"), BRONZE)
    path = pipeline.settings.table_path(BRONZE.namespace, BRONZE.name)
    write_partitioned(events(spark, directory), BRONZE, path, mode="append")
    stray = upkeep.orphan_files(spark, path, BRONZE)
    partition = F.regexp_extract("file_path", rf"/({DAY}=[^/]+/wiki=[^/]+)/", 1)
    return stray.groupBy(partition.alias("partition")).agg(
        (F.count(F.lit(1)) > 0).alias("has_orphans")
    ).withColumn("table_rows", pipeline.table(BRONZE).agg(F.count(F.lit(1)).alias("n")).scalar())


QUERIES: dict[str, Query] = {
    "gate_accepted": gate_accepted,
    "gate_rejected_by_reason": gate_rejected_by_reason,
    "gate_matched_by_reason": gate_matched_by_reason,
    "reject_envelope": reject_envelope,
    "feed_partition_counts": feed_partition_counts,
    "dedup_events": dedup_events,
    "edits_per_minute": edits_per_minute,
    "bot_vs_human_per_minute": bot_vs_human_per_minute,
    "page_edits_10min": page_edits_10min,
    "late_per_minute": late_per_minute,
    "top_pages_10min": top_pages_10min,
    "top_pages_daily": top_pages_daily,
    "bot_share": bot_share,
    "predicate_share": predicate_share,
    "skew_percentiles": skew_percentiles,
    "skew_percentiles_approx": skew_percentiles_approx,
    "table_counts": table_counts,
    "gold_total": gold_total,
    "table_growth": table_growth,
    "minimum_volume": minimum_volume,
    "duplicate_check": duplicate_check,
    "duplicated_keys": duplicated_keys,
    "residual_duplicates": residual_duplicates,
    "freshness": freshness,
    "freshness_no_events": freshness_no_events,
    "dedup_differing_copies": dedup_differing_copies,
    "pipeline_verdict": pipeline_verdict,
    "log_keyed": log_keyed,
    "log_landed": log_landed,
    "bronze_one_week": bronze_one_week,
    "stream_metrics": stream_metrics,
    "stream_batches": stream_batches,
    "rebuild_recovers_late": rebuild_recovers_late,
    "stream_batches_overwritten": stream_batches_overwritten,
    "sample_lines": sample_lines,
    "catalog_tables": catalog_tables,
    "event_rate": event_rate,
    "reject_rate": reject_rate,
    "late_rate": late_rate,
    "reject_share": reject_share,
    "schema_drift": schema_drift,
    "rebuild_gold": rebuild_gold,
    "rebuilt_edits": rebuilt_edits,
    "export_sample": export_sample,
    "file_stats": file_stats,
    "captured_blocks": captured_blocks,
    "stream_bronze": stream_bronze,
    "stream_rejects": stream_rejects,
    "stream_edits_per_minute": _from_log(EDITS),
    "stream_bot_vs_human": _from_log(BOTS),
    "stream_page_edits_10min": _from_log(PAGES),
    "stream_late": _from_log(LATE),
    "stream_edits_from_bronze": _from_bronze(EDITS),
    "stream_bots_from_bronze": _from_bronze(BOTS),
    "stream_pages_from_bronze": _from_bronze(PAGES),
    "stream_pipeline_counts": stream_pipeline_counts,
    "replay_equals_control": replay_equals_control,
    "compaction_equality": compaction_equality,
    "orphan_files": orphan_files,
    "compaction_of_late_files": compaction_of_late_files,
    "rebuild_changed": rebuild_changed,
    "rebuild_changed_days": rebuild_changed_days,
    "load_then_stream": load_then_stream,
    "difference_levels": difference_levels,
    "skew_from_sketches": skew_from_sketches,
    "distinct_from_sketches": distinct_from_sketches,
    "sessions_by_user": sessions_by_user,
    "stream_sessions": stream_sessions,
    "counts_from_footers": counts_from_footers,
    "state_rows": state_rows,
    "stream_top_pages": stream_top_pages,
    "silent_feeds": silent_feeds,
    "residual_by_filter": residual_by_filter,
    "rows_per_file": rows_per_file,
    "log_tolerates_loss": log_tolerates_loss,
    "captured_contents": captured_contents,
    "created_tables": created_tables,
}


def all_queries() -> dict[str, Query]:
    def with_plain_times(query: Query) -> Query:
        return lambda spark, directory: zoneless(query(spark, directory))

    return {name: with_plain_times(query) for name, query in QUERIES.items()}
