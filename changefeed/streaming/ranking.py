"""A ranking that is always up to date: the busiest pages of each window so far."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from changefeed.config import Settings, work_dir
from changefeed.functions import storage
from changefeed.operators.windows import top_pages
from changefeed.schema import DAY, PAGES

STORED = f"{', '.join(c.strip() for c in PAGES.columns.split(','))}, rank int, {DAY} date"


def read_ranking(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is: rank, page and count of each window and feed."""
    return spark.read.schema(STORED).parquet(path).drop(DAY)


def merge_ranking(batch: DataFrame, path: str, n: int) -> None:
    """Put a batch's new counts into the ranking, and keep ``n`` pages of each window and feed.

    A batch carries counts so far, not increments, so merging it again changes
    nothing. Counts never fall; a page that fell out of a ranking can only
    come back with a new count, which its batch brings. So the table needs no
    more than ``n`` rows of a window. Only days that the batch touches are
    read and overwritten.
    """
    spark = batch.sparkSession
    new = work_dir(spark, "ranking-batch")
    batch.withColumn(DAY, F.to_date("window_start")).write.parquet(new)
    counts = spark.read.parquet(new)
    days = [r[DAY] for r in counts.select(DAY).distinct().collect()]
    if not days:
        return
    known = spark.read.schema(STORED).parquet(path).filter(F.col(DAY).isin(days)).drop("rank")
    keys = ["window_start", "wiki", "title"]
    same = None
    for key in keys:
        equal = F.col(key).eqNullSafe(F.col(f"_{key}"))
        same = equal if same is None else same & equal
    others = known.join(counts.select(*[F.col(k).alias(f"_{k}") for k in keys]), same, "left_anti")
    ranked = top_pages(others.unionByName(counts), n)
    # The partitions overwritten below are among those read: written aside first.
    merged = work_dir(spark, "ranking")
    ranked.write.parquet(merged)
    rows = spark.read.parquet(merged)
    rows.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def stream_ranking(
    counts: DataFrame, path: str, settings: Settings, n: int = 10, name: str = "top-pages", available_now: bool = False
) -> StreamingQuery:
    """Keep the ranking at ``path`` from the running counts of pages (``PAGES_SPEC.build`` of a stream)."""
    storage.make_folder(counts.sparkSession, path)
    writer = counts.writeStream.queryName(re.sub(r"\W", "_", name)).outputMode("update")
    writer = writer.option("checkpointLocation", settings.checkpoint(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=settings.trigger)
    return writer.foreachBatch(lambda batch, _: merge_ranking(batch, path, n)).start()
