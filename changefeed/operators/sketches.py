"""Sketches kept per day and feed, merged for any span of days without a scan of the events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changefeed.operators.percentiles import POINTS


def day_sketches(df: DataFrame, value: Column, by: str, key: str = "meta_id", time: str = "event_time", k: int = 1024, lg: int = 14) -> DataFrame:
    """(day, by, values, keys): a KLL sketch of an integer measure and an HLL sketch of ids.

    One small row for each day and feed; built in one pass, on the map side
    first, so a busy feed sends one sketch per task.
    """
    rows = df.select(F.to_date(time).alias("day"), by, value.cast("bigint").alias("_value"), F.col(key).alias("_key"))
    return rows.groupBy("day", by).agg(
        F.kll_sketch_agg_bigint("_value", k).alias("values"), F.hll_sketch_agg("_key", lg).alias("keys")
    )


def merged(sketches: DataFrame, by: list[str], since=None, until=None) -> DataFrame:
    """One pair of sketches per group for the days ``since <= day < until``."""
    if since is not None:
        sketches = sketches.filter(F.col("day") >= F.lit(since))
    if until is not None:
        sketches = sketches.filter(F.col("day") < F.lit(until))
    return sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("values").alias("values"), F.hll_union_agg("keys").alias("keys"))


def percentiles_of(sketches: DataFrame, by: list[str], points: tuple[float, ...] = POINTS) -> DataFrame:
    """(by, point, value, event_count) from merged sketches; the rank of a value is off by less than ``rank_bound``."""
    marks = F.array(*[F.lit(float(p)) for p in points])
    pairs = F.arrays_zip(marks.alias("point"), F.kll_sketch_get_quantile_bigint("values", marks).alias("value"))
    found = sketches.select(*by, F.kll_sketch_get_n_bigint("values").alias("event_count"), F.inline(pairs))
    return found.select(*by, "point", "value", "event_count")


def distinct_of(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, distinct_keys): an estimate, off by about 1.04 / 2^(lg / 2) of it."""
    return sketches.select(*by, F.hll_sketch_estimate("keys").alias("distinct_keys"))


def rank_bound(k: int = 1024) -> float:
    """Error of a rank as a share of all values, at 99 % confidence, for either side of a sketch of this size."""
    return 2.296 / k**0.9021
