"""Upkeep of Parquet tables that a file sink appends to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings
from changefeed.functions import storage
from changefeed.operators.compaction import compact, expire
from changefeed.operators.writes import write_partitioned
from changefeed.schema import ALL_TABLES, DAY, Table
from changefeed.sources.copies import in_force
from changefeed.sources.tables import listed_tables

__all__ = ["compact", "expire", "write_partitioned"]


def file_stats(df: DataFrame, by: list[str], small_below: int = 32 * 1024 * 1024) -> DataFrame:
    """Number, size and rows of the files in each partition."""
    per_file = df.groupBy(
        *by,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(*by).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size").alias("byte_count"),
        F.sum("n").alias("row_count"),
        F.count(F.when(F.col("size") < small_below, F.lit(1))).alias("small_files"),
    )


def orphan_files(
    spark: SparkSession,
    path: str,
    table: Table,
    older_than: dt.datetime | None = None,
) -> DataFrame:
    """Data files below a table's folder that none of its rows come from.

    Both sides are listings: the files on storage, by a glob that bypasses the
    log of the sink, and the files that this log has committed, which is what
    Spark lists for the folder itself. No Parquet file is opened.
    """
    levels = "/*" * len(table.partitions)
    on_storage = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{path}{levels}/*.parquet")
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
    )
    if older_than is not None:
        on_storage = on_storage.filter(F.col("modified_at") < F.lit(older_than))
    in_use = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file_path")
    )
    return on_storage.join(in_use, "file_path", "left_anti")


def remove_orphans(
    spark: SparkSession, path: str, table: Table, older_than: dt.datetime
) -> list[str]:
    """Delete the orphans; on storage that tasks reach by themselves, in tasks."""
    return storage.delete_all(orphan_files(spark, path, table, older_than).select("file_path"))


def discovered(spark: SparkSession, settings: Settings) -> list[str]:
    """Full names of all tables in the catalog's namespaces of this pipeline,
    others than its own included; without a catalog there are none."""
    if not settings.catalog:
        return []
    spaces = sorted({table.namespace for table in ALL_TABLES})
    return [f"{s}.{name}" for s in spaces for name in listed_tables(spark, settings.table_name(s))]


def maintain(
    spark: SparkSession,
    settings: Settings,
    now: dt.datetime,
    through: dt.date,
    clean_orphans: bool = False,
    retention: dt.timedelta = dt.timedelta(hours=24),
    keep: int = 5,
    merge_at: int = 3,
) -> list[dict]:
    """Expiry, optional orphan removal and compaction of every table that is
    there; ``merge_at`` copies are merged into one, so that a read has few parts."""
    report = []
    for name in discovered(spark, settings):
        steps = iceberg_upkeep(name, settings.catalog, now - retention, keep, clean_orphans)
        for step in steps:
            spark.sql(step)
        report.append({"table": name, "steps": steps})
    for table in () if settings.catalog else ALL_TABLES:
        path = settings.table_path(table.namespace, table.name)
        if not storage.exists(spark, path):
            continue
        entry = {"table": table.full_name}
        entry["expired"] = expire(spark, settings, table, now, keep=keep, older_than=retention)
        entry["orphans"] = []
        if clean_orphans and storage.names(spark, path, f"{DAY}="):
            entry["orphans"] = remove_orphans(spark, path, table, now - retention)
        merge = len(in_force(spark, settings, table)) >= merge_at
        entry["copy"] = compact(spark, settings, table, through, full=merge)
        report.append(entry)
    return report


def drop_days(spark: SparkSession, path: str, before: dt.date) -> list[str]:
    """Row retention for a batch-written table: delete whole day folders.

    Not part of :func:`maintain`, and not for a folder that a sink still logs.
    """
    if storage.exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a streaming sink")
    # ISO dates sort as text.
    limit = f"{DAY}={before.isoformat()}"
    old = [name for name in storage.names(spark, path, f"{DAY}=") if name < limit]
    for name in old:
        storage.delete(spark, f"{path}/{name}")
    return old


def iceberg_upkeep(table: str, catalog: str, cutoff: dt.datetime, keep: int = 5, orphans: bool = False) -> list[str]:
    """The same three steps as procedure calls, for tables kept in Iceberg.

    They need that format's runtime and SQL extension; they were not run here.
    """
    moment = f"TIMESTAMP '{cutoff:%Y-%m-%d %H:%M:%S}'"
    calls = [f"expire_snapshots(table => '{table}', older_than => {moment}, retain_last => {keep})"]
    if orphans:
        calls.append(f"remove_orphan_files(table => '{table}', older_than => {moment})")
    calls.append(f"rewrite_data_files(table => '{table}')")
    return [f"CALL {catalog}.system.{call}" for call in calls]
