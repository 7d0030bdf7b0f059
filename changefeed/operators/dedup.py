"""One row per event id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def first_copies(
    df: DataFrame, key: str = "meta_id", order: list[Column] | None = None
) -> DataFrame:
    """Batch form: of each id the earliest copy, whatever order tasks run in.

    ``row_number() = 1`` becomes a group limit on both sides of the shuffle:
    every task sends at most one row per id, so an id that makes up a third of
    the input costs no more than another. The full text of a record takes part
    in the order by its hash alone.
    """
    if order is None:
        order = [F.col("ingested_at"), F.col("event_time"), F.xxhash64(*df.columns)]
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_copy", nth).filter(F.col("_copy") == 1).drop("_copy")


def _collapse(key: str, time: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.table(
                {"id": batch.column(key), "time": batch.column(time), "row": np.arange(batch.num_rows)}
            )
            # Null times sort last in either direction.
            order = [("id", "ascending"), ("time", "descending"), ("row", "ascending")]
            newest = rows.sort_by(order).group_by("id", use_threads=False).aggregate([("row", "first")])
            if newest.num_rows < batch.num_rows:
                batch = batch.take(pa.array(np.sort(newest.column("row_first").to_numpy())))
            yield batch

    return run


def collapse_batches(df: DataFrame, key: str = "meta_id", time: str = "event_time") -> DataFrame:
    """Of the copies within each Arrow batch the newest; stateless, memory of one batch.

    Streaming deduplication has no map-side step, so all copies of an id would
    go to one task. This leaves it one row per batch of ten thousand. The
    newest copy stays because an older one may lie behind the watermark: the
    watermark then drops an id only if it would drop every copy.
    """
    return df.mapInArrow(_collapse(key, time), df.schema)


def dedup_stream(
    df: DataFrame,
    key: str = "meta_id",
    time: str = "event_time",
    horizon: str = "2 minutes",
    collapse: bool = True,
) -> DataFrame:
    """Stream form: copies inside the watermark go, state older than it ends.

    The watermark is set here, once; aggregates on the result inherit it.
    """
    if collapse:
        df = collapse_batches(df, key, time)
    return df.withWatermark(time, horizon).dropDuplicatesWithinWatermark([key])


def dedup(df: DataFrame, horizon: str = "2 minutes", collapse: bool = True) -> DataFrame:
    """The form that suits the input."""
    if df.isStreaming:
        return dedup_stream(df, horizon=horizon, collapse=collapse)
    return first_copies(df)
