"""Reading the pipeline's tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings
from changefeed.schema import DAY, Table
from changefeed.sources.copies import in_force, loose, read_copies, read_named


def listed_tables(spark: SparkSession, namespace: str) -> list[str]:
    """What the catalog holds in a namespace, views of the session left out."""
    return [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary]


def between(
    df: DataFrame, table: Table, since: dt.datetime | None, until: dt.datetime | None
) -> DataFrame:
    """Rows with ``since <= time < until``.

    The bounds are put on the day column as well: Spark prunes partitions by
    that one, and cannot derive it from a bound on the time.
    """
    if since is not None:
        df = df.filter((F.col(DAY) >= F.to_date(F.lit(since))) & (F.col(table.time) >= F.lit(since)))
    if until is not None:
        df = df.filter((F.col(DAY) <= F.to_date(F.lit(until))) & (F.col(table.time) < F.lit(until)))
    return df


def read_files(spark: SparkSession, table: Table, path: str) -> DataFrame:
    return spark.read.schema(table.stored_schema).parquet(path)


def read_live(spark: SparkSession, settings: Settings, table: Table) -> DataFrame:
    """What the sink has committed, before any compaction."""
    if settings.in_catalog:
        return table.with_day(spark.table(settings.table_name(table.full_name)))
    return read_files(spark, table, settings.table_path(table.namespace, table.name))


def stream_table(spark: SparkSession, settings: Settings, table: Table, **options: str) -> DataFrame:
    """A table written by a file sink, as a stream of its commits.

    No cap on files per trigger by default: one commit holds files of many
    days, and reading only part of it would push the watermark past the rest.
    """
    if settings.in_catalog:
        reader = spark.readStream.options(**options)
        return reader.table(settings.table_name(table.full_name)).select(*table.column_names)
    return (
        spark.readStream.schema(table.stored_schema)
        .options(**options)
        .parquet(settings.table_path(table.namespace, table.name))
        .select(*table.column_names)
    )


def table_parts(spark: SparkSession, settings: Settings, table: Table) -> list[DataFrame]:
    """A table as the copies in force and the live files that none of them holds."""
    copies = [] if settings.in_catalog else in_force(spark, settings, table)
    if not copies:
        return [read_live(spark, settings, table)]
    rest = read_named(spark, settings, table, loose(spark, settings, table, copies))
    return [read_copies(spark, settings, table, copies), rest]


def read_table(
    spark: SparkSession,
    settings: Settings,
    table: Table,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
) -> DataFrame:
    """The whole table, or the part with ``since <= time < until``."""
    parts = [
        between(part, table, since, until).select(*table.column_names)
        for part in table_parts(spark, settings, table)
    ]
    return reduce(DataFrame.unionByName, parts)
