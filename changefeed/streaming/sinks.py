"""Sinks of streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from changefeed.config import Settings
from changefeed.operators.gate import envelope
from changefeed.schema import Table


def spread(df: DataFrame, table: Table, splits: int) -> DataFrame:
    """Bring the rows of a partition together, ``splits`` tasks to each.

    Without this every task writes a small file to every day and feed; with
    the partition columns alone, a feed with a third of the rows would be one
    task. The salt is a hash of the row's keys, the same on every replay. A
    table with a few rows for each minute needs no salt: a day has 1,440.
    """
    if table.per_minute:
        return df.repartition(*table.partitions)
    salt = F.pmod(F.xxhash64(*table.keys), F.lit(splits))
    return df.repartition(*table.partitions, salt)


def measured(df: DataFrame, table: Table) -> DataFrame:
    """Count what reaches the sink, which file sinks do not report.

    Placed after the last shuffle: there a task that is run again because an
    executor was lost counts once.
    """
    metrics = [F.count(F.lit(1)).alias("rows"), F.max(F.unix_micros(table.time)).alias("newest_micros")]
    if "late_event_count" in df.columns:
        metrics.append(F.sum("late_event_count").alias("late_events"))
    return df.observe(table.name, *metrics)


def _writer(df: DataFrame, settings: Settings, name: str, available_now: bool) -> DataStreamWriter:
    writer = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", settings.checkpoint(name))
    )
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=settings.trigger)


def append_to_table(
    df: DataFrame, table: Table, settings: Settings, available_now: bool = False
) -> StreamingQuery:
    """Exactly-once append. The sink's log lists the files of each batch once,
    however often the batch is run."""
    if settings.in_catalog:
        writer = _writer(measured(df, table), settings, table.name, available_now)
        writer = writer.format(settings.sink_format).options(**settings.sink_options)
        return writer.toTable(settings.table_name(table.full_name))
    rows = table.with_day(df)
    splits = settings.spread_over(df.sparkSession) if table.keys else 0
    if splits:
        rows = spread(rows, table, splits)
    writer = _writer(measured(rows, table), settings, table.name, available_now)
    return (
        writer.format("parquet")
        .partitionBy(*table.partitions)
        .start(settings.table_path(table.namespace, table.name))
    )


def overwrite_batches(
    df: DataFrame, path: str, settings: Settings, name: str, available_now: bool = False
) -> StreamingQuery:
    """At-least-once delivery made repeatable: each batch overwrites the folder
    of its own number, so a batch that runs twice is there once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _writer(df, settings, name, available_now).foreachBatch(write).start()


def send_to_kafka(
    rejected: DataFrame, settings: Settings, servers: str, topic: str, available_now: bool = False
) -> StreamingQuery:
    """Reject envelopes to a topic, at least once. Needs the Kafka connector;
    not run here."""
    return (
        _writer(envelope(rejected), settings, f"{topic}-rejects", available_now)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .start()
    )
