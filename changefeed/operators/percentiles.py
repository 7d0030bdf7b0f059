"""Distribution of a measure per group, exact at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The percentiles of a skew report.
POINTS = (0.5, 0.9, 0.95, 0.99, 0.999)
SECOND = 1_000_000


def ingest_skew() -> Column:
    """Microseconds between an event and its arrival."""
    return F.unix_micros("ingested_at") - F.unix_micros("event_time")


def exact_percentiles(
    df: DataFrame, value: Column, by: str, points: tuple[float, ...] = POINTS, width: int = SECOND
) -> DataFrame:
    """Nearest-rank percentiles of an integer measure: the smallest value with
    at least the share ``point`` of the group at or below it.

    A built-in exact percentile holds a whole group in one buffer. Here equal
    values collapse into counts before the shuffle, the counts are summed by
    bucket of ``width``, and only the buckets that hold a wanted rank are
    ordered value by value, each in a task of its own.
    """
    bucket = F.floor(F.col("value") / F.lit(width)).alias("bucket")
    histogram = df.select(by, value.alias("value")).groupBy(by, "value").agg(
        F.count(F.lit(1)).alias("n")
    ).select(by, bucket, "value", "n")

    whole = Window.partitionBy(by)
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = histogram.groupBy(by, "bucket").agg(F.sum("n").alias("bucket_n"))
    wanted = (
        buckets.select(
            by,
            "bucket",
            "bucket_n",
            F.coalesce(F.sum("bucket_n").over(before), F.lit(0)).alias("below"),
            F.sum("bucket_n").over(whole).alias("total"),
        )
        .withColumn("point", F.explode(F.array(*[F.lit(float(p)) for p in points])))
        .withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("point") * F.col("total").cast("double"))))
        .filter((F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + F.col("bucket_n")))
    )
    upto = Window.partitionBy(by, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    places = wanted.select(by, "bucket").distinct()
    inside = histogram.join(places, [by, "bucket"], "left_semi").select(
        by, "bucket", "value", F.sum("n").over(upto).alias("upto")
    )
    return (
        wanted.join(inside, [by, "bucket"])
        .filter(F.col("below") + F.col("upto") >= F.col("rank"))
        .groupBy(by, "point")
        .agg(F.min("value").alias("value"), F.max("total").alias("event_count"))
    )


def approximate_percentiles(
    df: DataFrame, value: Column, by: str, points: tuple[float, ...] = POINTS, accuracy: int = 10_000
) -> DataFrame:
    """The cheap form for dashboards: one pass, a sketch of fixed size per group."""
    marks = F.array(*[F.lit(float(p)) for p in points])
    values = F.percentile_approx(value, list(points), accuracy)
    pairs = F.arrays_zip(marks.alias("point"), F.col("values").alias("value"))
    return df.groupBy(by).agg(values.alias("values")).select(by, F.inline(pairs))
