"""Event-time windows: counts, shares and rankings.

Everything here takes a batch or a stream, except the rankings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from changefeed.schema import BOTS, EDITS, LATE, PAGES, Table


def flatten_window(df: DataFrame, *columns: str) -> DataFrame:
    """``window_start`` and ``window_end`` in place of the window struct."""
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns
    )


def windowed_count(
    df: DataFrame,
    length: str,
    keys: list[str],
    count_name: str,
    time: str = "event_time",
    slide: str | None = None,
) -> DataFrame:
    """Rows per window and key. Counted on the map side first, so a busy key
    sends one partial count per task and window."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    counts = df.groupBy(window, *keys).agg(F.count(F.lit(1)).alias(count_name))
    return flatten_window(counts, *keys, count_name)


def sessions(df: DataFrame, gap: str, keys: list[str], time: str = "event_time") -> DataFrame:
    """Runs of events of a key with less than ``gap`` between them: first event, end (the last one and the gap), count.

    In a stream a session is state that later events extend or merge with its
    neighbour, and is emitted once the watermark has passed its end.
    """
    found = df.groupBy(F.session_window(time, gap).alias("window"), *keys).agg(F.count(F.lit(1)).alias("event_count"))
    return flatten_window(found, *keys, "event_count").withColumnsRenamed(
        {"window_start": "session_start", "window_end": "session_end"}
    )


def is_late(after: str = "2 minutes") -> Column:
    """Arrived more than ``after`` behind its own event time."""
    return F.col("ingested_at") > F.col("event_time") + F.expr(f"INTERVAL {after}")


@dataclass(frozen=True)
class GoldSpec:
    """How a gold table is computed from accepted, deduplicated events."""

    table: Table
    length: str
    keys: tuple[str, ...]
    count_name: str
    late_only: bool = False

    @property
    def inputs(self) -> list[str]:
        """The columns of an event that the counts need, its id among them."""
        return ["meta_id", "event_time", *self.keys, *(["ingested_at"] if self.late_only else [])]

    def build(
        self, events: DataFrame, late_after: str = "2 minutes", length: str | None = None
    ) -> DataFrame:
        if self.late_only:
            events = events.filter(is_late(late_after))
        return windowed_count(events, length or self.length, list(self.keys), self.count_name)


EDITS_SPEC = GoldSpec(EDITS, "1 minute", ("wiki",), "edit_count")
BOTS_SPEC = GoldSpec(BOTS, "1 minute", ("wiki", "bot"), "edit_count")
PAGES_SPEC = GoldSpec(PAGES, "10 minutes", ("wiki", "title"), "edit_count")
LATE_SPEC = GoldSpec(LATE, "1 minute", ("wiki",), "late_event_count", late_only=True)
GOLD_SPECS = (EDITS_SPEC, BOTS_SPEC, PAGES_SPEC, LATE_SPEC)


def edits_from_bots(bots: DataFrame) -> DataFrame:
    """The per-minute counts from the finer ones by bot flag, without a scan
    of the events."""
    return bots.groupBy("window_start", "window_end", "wiki").agg(
        F.sum("edit_count").alias("edit_count")
    )


def settled(counts: DataFrame, events: DataFrame, watermark: str) -> DataFrame:
    """The windows that a stream over ``events`` has closed at its end.

    Append mode emits a window once the watermark has reached its end, and the
    watermark is kept in whole milliseconds.
    """
    newest = F.date_trunc("millisecond", F.max("event_time"))
    limit = events.agg((newest - F.expr(f"INTERVAL {watermark}")).alias("limit"))
    return counts.filter(F.col("window_end") <= limit.scalar())


def top_pages(pages: DataFrame, n: int) -> DataFrame:
    """The ``n`` busiest pages of each feed and window, ties by title.

    The rank limit is applied before the shuffle as well as after it.
    """
    order = Window.partitionBy("window_start", "wiki").orderBy(F.desc("edit_count"), F.asc("title"))
    ranked = pages.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n)


def bot_share(bots: DataFrame) -> DataFrame:
    """Share of bot events per window and feed."""
    by_bot = F.sum(F.when(F.col("bot"), F.col("edit_count")).otherwise(0))
    return bots.groupBy("window_start", "window_end", "wiki").agg(
        F.sum("edit_count").alias("edit_count"),
        (by_bot.cast("double") / F.sum("edit_count").cast("double")).alias("bot_share"),
    )


def predicate_share(
    events: DataFrame, predicate: Column, length: str, keys: list[str], time: str = "event_time"
) -> DataFrame:
    """Share of events for which ``predicate`` holds, per window and key.

    A revert rate is this with the caller's own test for a revert.
    """
    counts = events.groupBy(F.window(time, length), *keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count(F.when(predicate, F.lit(1))).alias("match_count"),
    )
    share = F.col("match_count").cast("double") / F.col("event_count").cast("double")
    return flatten_window(counts.withColumn("share", share), *keys, "event_count", "match_count", "share")


def rate(
    df: DataFrame, time: str, seconds: int, keys: list[str] | None = None, weight: Column | None = None
) -> DataFrame:
    """Rows (or the sum of ``weight``) per second, by window of ``seconds``."""
    keys = keys or []
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(F.window(time, f"{seconds} seconds"), *keys).agg(total.alias("n"))
    per_second = F.col("n").cast("double") / F.lit(float(seconds))
    return flatten_window(counts.withColumn("per_second", per_second), *keys, "n", "per_second")
