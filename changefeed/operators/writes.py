"""Batch writes of partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changefeed.schema import Table


def write_partitioned(df: DataFrame, table: Table, path: str, mode: str = "overwrite", only_given: bool = False) -> None:
    """Batch write in files of a good size.

    The rebalance hint lets Spark choose partitions from the sizes it has
    measured: small days and feeds share a task, a busy feed is split over
    many. ``only_given`` overwrites the partitions that ``df`` has rows for and
    leaves the others.
    """
    rows = table.with_day(df)
    writer = rows.hint("rebalance", *[F.col(c) for c in table.partitions]).write.mode(mode)
    if only_given:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*table.partitions).parquet(path)
