"""Jobs to hand to spark-submit.

    spark-submit ... -m changefeed stream   --root R --path LOG
    spark-submit ... -m changefeed backfill --root R --path LOG
    spark-submit ... -m changefeed load     --root R --path LOG
    spark-submit ... -m changefeed counts | dup-check | freshness | verdict |
                                   maintain | export | rebuild | refresh | drift   --root R
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings, build_session
from changefeed.functions import storage
from changefeed.operators import exports, incremental, quality, rebuild, upkeep
from changefeed.schema import ALL_TABLES, BRONZE, DAY, GOLD, create_tables
from changefeed.sources import LogSource, read_table
from changefeed.streaming import Pipeline, ProgressRecorder
from changefeed.streaming.handover import first_load


def source_of(args) -> LogSource:
    options = dict(option.split("=", 1) for option in args.option)
    return LogSource(
        args.format, args.path, options, max_files=args.max_files or None, max_offsets=args.max_offsets or None
    )


def show_all(df: DataFrame) -> None:
    """Print every row of a small report."""
    print(" | ".join(df.columns), flush=True)
    for row in df.toLocalIterator():
        print(" | ".join(str(value) for value in row), flush=True)


def tables_of(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    return {
        table.name: read_table(spark, settings, table)
        for table in ALL_TABLES
        if settings.in_catalog
        or storage.exists(spark, settings.table_path(table.namespace, table.name))
    }


def stream(spark: SparkSession, settings: Settings, args) -> None:
    """The standing pipeline, until a query fails. ``backfill`` stops when the
    log is read."""
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    create_tables(spark, settings)
    pipeline = Pipeline(spark, source_of(args).read(spark), settings)
    try:
        if args.job == "backfill":
            pipeline.run_available()
            return
        pipeline.start()
        while not spark.streams.awaitAnyTermination(args.flush_seconds):
            recorder.flush(spark, settings.metrics_path)
    finally:
        recorder.flush(spark, settings.metrics_path)
        pipeline.stop()


def load(spark: SparkSession, settings: Settings, args) -> None:
    """The log's present files in batch, before the streams are started for the first time."""
    for name, copy in first_load(spark, settings, source_of(args)).items():
        print(name, copy.row_count, flush=True)


def counts(spark: SparkSession, settings: Settings, args) -> None:
    """Counts of all tables, kept with their time, and growth since the last."""
    path = f"{settings.root}/metrics/counts"
    sample = quality.table_counts(tables_of(spark, settings))
    sample.withColumn("sampled_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
    # A row for each table.
    show_all(quality.newest_growth(spark.read.parquet(path)).orderBy("table_name"))
    show_all(sample)


def dup_check(spark: SparkSession, settings: Settings, args) -> int:
    found = quality.duplicate_check(read_table(spark, settings, BRONZE))
    show_all(found)
    return int(found.filter("total <> distinct_ids").count())


def newest_age(spark: SparkSession, settings: Settings, limit: int) -> DataFrame:
    """Freshness of bronze, read from its newest day folder: no event of an
    older day can be newer."""
    since = None
    if not settings.in_catalog:
        days = storage.names(spark, settings.table_path(BRONZE.namespace, BRONZE.name), f"{DAY}=")
        dated = [d.split("=", 1)[1] for d in days if d[len(DAY) + 1 :][:1].isdigit()]
        if dated:
            since = dt.datetime.fromisoformat(max(dated)).replace(tzinfo=dt.timezone.utc)
    return quality.freshness(read_table(spark, settings, BRONZE, since), limit_seconds=limit)


def freshness(spark: SparkSession, settings: Settings, args) -> int:
    found = newest_age(spark, settings, args.limit)
    show_all(found)
    return int(found.filter("NOT within_limit").count())


def verdict(spark: SparkSession, settings: Settings, args) -> int:
    """One row, and exit code 1 unless all of it holds. Growth is between the
    last two runs of ``counts``."""
    found = quality.pipeline_verdict(
        spark.read.parquet(f"{settings.root}/metrics/counts"),
        newest_age(spark, settings, args.limit),
        quality.duplicate_check(read_table(spark, settings, BRONZE)),
        BRONZE.name,
        [table.name for table in GOLD],
    )
    show_all(found)
    return int(found.filter("NOT passed").count())


def maintain(spark: SparkSession, settings: Settings, args) -> None:
    now = dt.datetime.now(dt.timezone.utc)
    through = (now - dt.timedelta(days=args.days)).date()
    for entry in upkeep.maintain(spark, settings, now, through, args.orphans):
        print(entry, flush=True)


def export(spark: SparkSession, settings: Settings, args) -> None:
    for table in GOLD:
        exports.export_parquet(read_table(spark, settings, table), f"{args.out}/{table.name}", args.files)
    sample = exports.bronze_sample(read_table(spark, settings, BRONZE), args.sample)
    exports.export_parquet(sample, f"{args.out}/bronze_recentchange_sample", args.files)
    if args.path:
        log = source_of(args).read(spark, stream=False)
        exports.export_json_lines(log, f"{args.out}/sample_events")


def rebuild_gold(spark: SparkSession, settings: Settings, args) -> None:
    rebuild.rebuild_gold(spark, read_table(spark, settings, BRONZE), args.out, watermark=args.watermark)


def refresh(spark: SparkSession, settings: Settings, args) -> None:
    """Gold tables below ``--out``, recounted for the days and feeds that bronze has new files of."""
    found = incremental.rebuild_changed(spark, settings, args.out, late_after=settings.late_after, once=settings.bronze == "once")
    for name, changed in found.items():
        print(name, changed.select(DAY, BRONZE.feed).distinct().count(), flush=True)


def drift(spark: SparkSession, settings: Settings, args) -> None:
    bronze = read_table(spark, settings, BRONZE)
    found = quality.schema_drift(spark, bronze, F.to_date("event_time"))
    exports.export_parquet(found, f"{args.out}/schema_drift")
    kept = spark.read.parquet(f"{args.out}/schema_drift")
    # The newest day in full; all days are in the table.
    newest = kept.agg(F.max("day").alias("day"))
    show_all(kept.join(newest, "day").orderBy("json_key", "json_type"))


JOBS = {
    "stream": stream,
    "backfill": stream,
    "load": load,
    "counts": counts,
    "dup-check": dup_check,
    "freshness": freshness,
    "verdict": verdict,
    "maintain": maintain,
    "export": export,
    "rebuild": rebuild_gold,
    "refresh": refresh,
    "drift": drift,
}


def main(argv: list[str] | None = None) -> int:
    """The exit code: 1 where a check did not hold."""
    parser = argparse.ArgumentParser(prog="changefeed")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of tables and checkpoints")
    parser.add_argument("--format", default="text", choices=["text", "parquet", "kafka"])
    parser.add_argument("--path", help="folder of the log")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    # Fixed value: 5000 offsets for one micro-batch of a Kafka log.
    parser.add_argument("--max-files", type=int, default=1_000, help="files of a file log for one micro-batch; 0: all")
    parser.add_argument("--max-offsets", type=int, default=5_000, help="records of a Kafka log for one micro-batch; 0: all")
    parser.add_argument("--trigger", default="60 seconds")
    parser.add_argument("--horizon", default="2 minutes", help="how far apart copies may lie")
    parser.add_argument("--watermark", help="how late an event may be for its window")
    parser.add_argument("--late-horizon", default="1 hour", help="how late an event still counts as late")
    parser.add_argument("--state-partitions", type=int, help="width of the stateful operators, kept for good")
    parser.add_argument("--splits", type=int, help="tasks that share a day and feed when written")
    parser.add_argument("--keep-copies", action="store_true", help="no collapse before the shuffle by id")
    parser.add_argument("--bronze", default="once", choices=["once", "all"], help="each id once, or every record")
    parser.add_argument("--gold-from", default="bronze", choices=["bronze", "source"])
    parser.add_argument("--catalog", help="keep the tables there, as Iceberg tables")
    parser.add_argument("--flush-seconds", type=int, default=60)
    parser.add_argument("--out", default="exports")
    parser.add_argument("--files", type=int)
    parser.add_argument("--sample", type=int, default=50_000)
    parser.add_argument("--limit", type=int, default=120, help="seconds of age that count as fresh")
    parser.add_argument("--days", type=int, default=2)
    parser.add_argument("--orphans", action="store_true")
    args = parser.parse_args(argv)

    settings = Settings(
        root=args.root.rstrip("/"),
        trigger=args.trigger,
        horizon=args.horizon,
        gold_from=args.gold_from,
        bronze=args.bronze,
        late_horizon=args.late_horizon,
        state_partitions=args.state_partitions,
        splits=args.splits,
        collapse_copies=not args.keep_copies,
        catalog=args.catalog,
        sink_format="iceberg" if args.catalog else "parquet",
        **({"watermark": args.watermark} if args.watermark else {}),
    )
    return JOBS[args.job](build_session(), settings, args) or 0


if __name__ == "__main__":
    sys.exit(main())
