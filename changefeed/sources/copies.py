"""Compact copies of a table, and the live files that no copy holds.

All copies of a table are one Parquet table, partitioned by ``copy`` before the
table's own partitions. Next to it stand the names of the live files that each
copy holds, and the switch: the copies that are in force, as a whole, one row
for each change. What a reader takes from the live table follows from file
names alone, so no clock and no order of commits matters.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings
from changefeed.functions import storage
from changefeed.schema import DAY, Table

#: Copies whose rows were never in the live table begin with this; they hold no files.
LOADED = "load-"

SWITCH_DDL = "version bigint, copies array<string>, created_at timestamp"


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``file_path`` and day of a table's data files: those that the sink's log
    names, or all of a table without one. A listing; no file is opened."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], f"file_path string, {DAY} date")
    day = F.regexp_extract("file_path", rf"/{DAY}=([0-9-]+)/", 1).cast("date").alias(DAY)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("_metadata.file_path").alias("file_path")).select("file_path", day)


def rows_path(settings: Settings, table: Table) -> str:
    return f"{settings.copies_path(table.namespace, table.name)}/rows"


def held_path(settings: Settings, table: Table) -> str:
    return f"{settings.copies_path(table.namespace, table.name)}/held"


def switch_path(settings: Settings, table: Table) -> str:
    return f"{settings.copies_path(table.namespace, table.name)}/switch"


def switches(spark: SparkSession, settings: Settings, table: Table) -> list:
    """All changes of the copies in force, oldest first: a row for each run of the compaction job."""
    path = switch_path(settings, table)
    if not storage.exists(spark, path):
        return []
    return spark.read.schema(SWITCH_DDL).parquet(path).orderBy("version").collect()


def switch(spark: SparkSession, settings: Settings, table: Table, copies: list[str]) -> None:
    """Put ``copies`` in force. One file: a reader sees it or does not."""
    known = switches(spark, settings, table)
    row = (known[-1].version + 1 if known else 0, copies, dt.datetime.now())
    spark.createDataFrame([row], SWITCH_DDL).coalesce(1).write.mode("append").parquet(switch_path(settings, table))


def in_force(spark: SparkSession, settings: Settings, table: Table) -> list[str]:
    known = switches(spark, settings, table)
    return list(known[-1].copies) if known else []


def read_copies(spark: SparkSession, settings: Settings, table: Table, copies: list[str]) -> DataFrame:
    path = rows_path(settings, table)
    reader = spark.read.schema(f"{table.stored_schema}, copy string").option("basePath", path)
    return reader.parquet(*[f"{path}/copy={c}" for c in copies]).drop("copy")


def held(spark: SparkSession, settings: Settings, table: Table, copies: list[str]) -> DataFrame:
    path = held_path(settings, table)
    copies = [c for c in copies if not c.startswith(LOADED)]
    if not copies:
        return spark.createDataFrame([], f"file_path string, {DAY} date, copy string")
    reader = spark.read.schema(f"file_path string, {DAY} date, copy string").option("basePath", path)
    return reader.parquet(*[f"{path}/copy={c}" for c in copies])


def loose(spark: SparkSession, settings: Settings, table: Table, copies: list[str]) -> DataFrame:
    """Committed files of the live table that no copy holds."""
    files = committed(spark, settings.table_path(table.namespace, table.name))
    return files.join(held(spark, settings, table, copies), "file_path", "left_anti")


def sources(spark: SparkSession, settings: Settings, table: Table) -> DataFrame:
    """The files that rows came in by: those of the live table and of loaded copies."""
    files = committed(spark, settings.table_path(table.namespace, table.name))
    for copy in in_force(spark, settings, table):
        if copy.startswith(LOADED):
            files = files.unionByName(committed(spark, f"{rows_path(settings, table)}/copy={copy}"))
    return files


def read_named(spark: SparkSession, settings: Settings, table: Table, files: DataFrame) -> DataFrame:
    """Rows of some of the live table's files. Their names pass through the
    driver, as the listing of any table does."""
    path = settings.table_path(table.namespace, table.name)
    names = [unquote(r.file_path) for r in files.select("file_path").toLocalIterator()]
    if not names:
        return spark.createDataFrame([], table.stored_schema)
    return spark.read.schema(table.stored_schema).option("basePath", path).parquet(*names)
