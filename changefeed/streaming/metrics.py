"""Figures about the running queries, kept as a table."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from changefeed.operators.quality import freshness
from changefeed.operators.windows import rate

METRICS_DDL = (
    "query string, batch_id bigint, at timestamp, input_rows bigint, rows_written bigint, "
    "late_events bigint, dropped_rows bigint, newest_event_time timestamp, duration_seconds double"
)

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def progress_row(progress) -> tuple:
    """One micro-batch as a row of the metrics table."""
    seen = progress.observedMetrics.get(progress.name)
    values = seen.asDict() if seen is not None else {}
    newest = values.get("newest_micros")
    dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
    return (
        progress.name,
        progress.batchId,
        dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")),
        progress.numInputRows,
        values.get("rows", 0),
        values.get("late_events") or 0,
        dropped,
        None if newest is None else EPOCH + dt.timedelta(microseconds=newest),
        progress.durationMs.get("triggerExecution", 0) / 1000.0,
    )


class ProgressRecorder(StreamingQueryListener):
    """Gathers a row per micro-batch; ``flush`` appends them to a table.

    The rows are few (one per batch and query) and are written together, so
    that the table does not become a heap of one-row files.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._lock = threading.Condition()
        self._started: set[str] = set()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        with self._lock:
            self._started.add(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = progress_row(event.progress)
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def await_started_ended(self, seconds: float = 60) -> None:
        """Until all batches of the runs that have started have been heard of:
        events come after the queries themselves, in order."""
        with self._lock:
            if not self._lock.wait_for(lambda: self._ended >= self._started, seconds):
                raise TimeoutError(f"no end of {self._started - self._ended} within {seconds} seconds")

    def take(self) -> list[tuple]:
        with self._lock:
            rows, self._rows = self._rows, []
        return rows

    def flush(self, spark: SparkSession, path: str) -> int:
        rows = self.take()
        if rows:
            spark.createDataFrame(rows, METRICS_DDL).coalesce(1).write.mode("append").parquet(path)
        return len(rows)


def recorded(spark: SparkSession, path: str, run: Callable[[], object]) -> DataFrame:
    """The metrics of all queries that ``run`` starts and ends, written to ``path``.

    Queries themselves remember only their last batches.
    """
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        run()
        recorder.await_started_ended()
    finally:
        spark.streams.removeListener(recorder)
    recorder.flush(spark, path)
    return read_metrics(spark, path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_DDL).parquet(path)


def stream_freshness(metrics: DataFrame, query: str, now: Column | None = None, limit_seconds: int = 120) -> DataFrame:
    """Age of the newest event that a running query has written, from its metrics.

    Ages and verdict as for the table itself; no data is read.
    """
    seen = metrics.filter(F.col("query") == query)
    return freshness(seen, now, limit_seconds, "newest_event_time")


def rows_per_table(metrics: DataFrame) -> DataFrame:
    """Rows written and late events, by query."""
    return metrics.groupBy("query").agg(
        F.sum("rows_written").alias("rows_written"),
        F.sum("late_events").alias("late_events"),
        F.sum("dropped_rows").alias("dropped_rows"),
    )


def last_duration(metrics: DataFrame) -> DataFrame:
    """Duration of the newest batch of each query."""
    return metrics.groupBy("query").agg(
        F.max_by("duration_seconds", "batch_id").alias("duration_seconds")
    )


def newest_so_far(metrics: DataFrame) -> DataFrame:
    """Newest event time after each batch; it never moves back."""
    upto = Window.partitionBy("query").orderBy("batch_id").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return metrics.select(
        "query", "batch_id", "at", F.max("newest_event_time").over(upto).alias("newest_event_time")
    )


def write_rate(metrics: DataFrame, seconds: int = 60) -> DataFrame:
    """Rows per second written to each table."""
    return rate(metrics, "at", seconds, ["query"], F.col("rows_written"))


def reject_rate(metrics: DataFrame, seconds: int = 300) -> DataFrame:
    """Rejected rows per second."""
    return rate(metrics.filter(F.col("query") == "rejects"), "at", seconds, None, F.col("rows_written"))


def late_rate(metrics: DataFrame, seconds: int = 300) -> DataFrame:
    """Late events (not rows of their table) per second."""
    return rate(
        metrics.filter(F.col("query") == "late_arrivals"), "at", seconds, None, F.col("late_events")
    )
