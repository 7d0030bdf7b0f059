"""Feeds that fall silent, noticed without any input: timers of processing time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SILENCE_DDL = "feed string, at timestamp, silent boolean, newest_event_time timestamp"
# Inside the operator times are numbers: Python's have no zone in rows and one in states.
_STATE_DDL = "newest bigint, silent boolean, timer bigint"
_ROW_DDL = "feed string, at bigint, silent boolean, newest bigint"


def newest_of_batches(events: DataFrame, feed: str = "wiki", time: str = "event_time") -> DataFrame:
    """(feed, time): of each feed the newest time, in microseconds, in each Arrow batch; stateless.

    The timers need no more, and a busy feed then sends its task one row for
    ten thousand events.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).group_by("feed", use_threads=False).aggregate([("time", "max")])
            for part in rows.select(["feed", "time_max"]).rename_columns(["feed", "time"]).to_batches():
                yield part

    found = events.select(F.col(feed).alias("feed"), F.unix_micros(time).alias("time"))
    return found.mapInArrow(run, found.schema)


class Silence(StatefulProcessor):
    """Per feed the newest event, and a timer that every arrival puts off."""

    def __init__(self, limit_seconds: float):
        self.limit = int(limit_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("feed", _STATE_DDL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        now = timerValues.getCurrentProcessingTimeInMs()
        newest, silent, timer = self.state.get() if self.state.exists() else (None, False, None)
        for row in rows:
            if row.time is not None and (newest is None or row.time > newest):
                newest = row.time
        if timer is not None:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.limit)
        self.state.update((newest, False, now + self.limit))
        if silent:
            yield Row(feed=key[0], at=now, silent=False, newest=newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        newest = self.state.get()[0]
        self.state.update((newest, True, None))
        yield Row(feed=key[0], at=timerValues.getCurrentProcessingTimeInMs(), silent=True, newest=newest)

    def close(self) -> None:
        pass


def silent_feeds(events: DataFrame, limit_seconds: float, feed: str = "wiki", time: str = "event_time") -> DataFrame:
    """A row when a feed has sent nothing for ``limit_seconds``, though no other
    input arrives either, and one when it sends again.

    For queries with a processing-time trigger: a query that ends when its
    input is read waits for no timer.
    """
    rows = newest_of_batches(events, feed, time)
    told = rows.groupBy("feed").transformWithState(Silence(limit_seconds), _ROW_DDL, "Append", "ProcessingTime")
    return told.select("feed", F.timestamp_millis("at").alias("at"), "silent", F.timestamp_micros("newest").alias("newest_event_time"))
