"""Checks on tables, each a query that returns its findings as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from changefeed.functions import once
from changefeed.schema import DECLARED_KEYS


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, in one query."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def footer_counts(spark: SparkSession, path: str, schema: str, by: list[str]) -> DataFrame:
    """Rows per partition of a Parquet table, from the footers of its files: no column is read.

    Spark pushes counts down in its second source interface only, which is
    chosen by a session setting, so the plan belongs to a session of its own.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session.read.schema(schema).parquet(path).groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def total_rows(counts: DataFrame, names: list[str]) -> DataFrame:
    """Sum of the counts of some tables, as ``gold`` of all gold tables."""
    return counts.filter(F.col("table_name").isin(names)).agg(F.sum("row_count").alias("row_count"))


def growth(samples: DataFrame) -> DataFrame:
    """Change of each table's count since its sample before, with a verdict.

    ``samples`` holds ``table_name``, ``sampled_at`` and ``row_count``.
    """
    previous = F.lag("row_count").over(Window.partitionBy("table_name").orderBy("sampled_at"))
    return (
        samples.withColumn("previous_count", previous)
        .filter(F.col("previous_count").isNotNull())
        .withColumn("growth", F.col("row_count") - F.col("previous_count"))
        .withColumn("grew", F.col("growth") > 0)
    )


def newest_growth(samples: DataFrame) -> DataFrame:
    """Growth of every table at its last sample."""
    newest = Window.partitionBy("table_name").orderBy(F.col("sampled_at").desc())
    return growth(samples).withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def pipeline_verdict(samples: DataFrame, fresh: DataFrame, duplicates: DataFrame, bronze: str, gold: list[str]) -> DataFrame:
    """One row: did bronze and gold grow at their last sample, is the newest
    event fresh, are there no duplicates, and do all of them hold? What is not
    known does not hold."""
    last = newest_growth(samples)
    grown = last.agg(
        F.coalesce(F.bool_and(F.when(F.col("table_name") == bronze, F.col("grew"))), F.lit(False)).alias("bronze_grew"),
        F.coalesce(F.sum(F.when(F.col("table_name").isin(gold), F.col("growth"))) > 0, F.lit(False)).alias("gold_grew"),
    )
    unique = duplicates.select(F.col("total") == F.col("distinct_ids"))
    return (
        grown.withColumn("fresh", fresh.select("within_limit").scalar())
        .withColumn("no_duplicates", unique.scalar())
        .withColumn("passed", F.expr("bronze_grew AND gold_grew AND fresh AND no_duplicates"))
    )


def duplicate_check(df: DataFrame, key: str = "meta_id", approximate: bool = False) -> DataFrame:
    """Total and distinct ids with a verdict.

    The exact count groups by id on the map side first. The approximate one is
    for a quick look: its sketch has a fixed size but an error.
    """
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    # The two verdicts.
    verdict = F.when(F.col("total") == F.col("distinct_ids"), "OK-NO-DUPLICATES").otherwise(
        "DUPLICATES-FOUND"
    )
    return df.agg(F.count(F.lit(1)).alias("total"), distinct.alias("distinct_ids")).withColumn(
        "verdict", verdict
    )


def duplicated_keys(df: DataFrame, key: str = "meta_id") -> DataFrame:
    """The ids that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def residual_duplicates(
    df: DataFrame, horizon: str, key: str = "meta_id", time: str = "event_time"
) -> DataFrame:
    """Ids whose copies lie further apart than the deduplication horizon."""
    spread = F.max(time) - F.min(time)
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(time).alias("first_time"),
            F.max(time).alias("last_time"),
            spread.alias("spread"),
        )
        .filter((F.col("copies") > 1) & (F.col("spread") > F.expr(f"INTERVAL {horizon}")))
        .drop("spread")
    )


def freshness(
    df: DataFrame, now: Column | None = None, limit_seconds: int = 120, time: str = "event_time"
) -> DataFrame:
    """Age of the newest event, and whether it is within the limit.

    Without any event the age is null and the limit is not kept.
    """
    now = F.current_timestamp() if now is None else now
    age = (F.unix_micros(now) - F.unix_micros("newest_event_time")).cast("double") / F.lit(1e6)
    return (
        df.agg(F.max(time).alias("newest_event_time"))
        .withColumn("age_seconds", F.when(age.isNotNull(), F.greatest(F.lit(0.0), age)))
        .withColumn(
            "within_limit",
            F.coalesce(F.col("age_seconds") < F.lit(float(limit_seconds)), F.lit(False)),
        )
    )


def minimum_volume(df: DataFrame, n: int = 100) -> DataFrame:
    """Are there ``n`` rows? No task reads more than ``n`` of them."""
    return (
        df.select(F.lit(1).alias("one"))
        .limit(n)
        .agg(F.count("one").alias("observed"))
        .withColumn("enough", F.col("observed") >= n)
    )


def reject_share(records: DataFrame, limit: float, length: str = "5 minutes") -> DataFrame:
    """Share of rejects among the arrivals of each window, with an alert flag.

    ``records`` are judged ones, with ``rejected`` and ``ingested_at``.
    """
    share = F.col("reject_count").cast("double") / F.col("record_count").cast("double")
    return (
        records.groupBy(F.window("ingested_at", length))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count_if("rejected").alias("reject_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "record_count",
            "reject_count",
            share.alias("reject_share"),
            (share > F.lit(limit)).alias("alert"),
        )
    )


def key_types(spark: SparkSession, raw: DataFrame, day: Column) -> DataFrame:
    """Rows per day, JSON key and JSON type, top-level keys and those of ``meta``.

    Each record is taken apart once, and equal (key, type) pairs are counted
    before the shuffle. Records that are no objects have no keys.
    """
    parsed = raw.select(day.alias("day"), once(F.struct(F.try_parse_json("raw_json").alias("doc"))))
    members = spark.tvf.variant_explode(F.col("doc").outer()).toDF("pos", "key", "value")
    inside = F.when(F.col("key") == "meta", F.col("value")).outer()
    inner = spark.tvf.variant_explode_outer(inside).toDF("inner_pos", "inner_key", "inner_value")
    entries = (
        parsed.lateralJoin(members)
        .filter(F.col("key").isNotNull())
        .lateralJoin(inner)
    )
    # A member of ``meta`` gives a row of its own; ``meta`` itself goes with
    # the first of them.
    own = F.when(
        F.coalesce("inner_pos", F.lit(0)) == 0,
        F.struct(F.col("key").alias("json_key"), _kind("value").alias("json_type")),
    )
    nested = F.when(
        F.col("inner_key").isNotNull(),
        F.struct(
            F.concat(F.lit("meta."), F.col("inner_key")).alias("json_key"),
            _kind("inner_value").alias("json_type"),
        ),
    )
    return (
        entries.select("day", F.inline(F.array_compact(F.array(own, nested))))
        .groupBy("day", "json_key", "json_type")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def _kind(value: str) -> Column:
    """OBJECT<...> and ARRAY<...> count by their kind alone."""
    return F.regexp_extract(F.schema_of_variant(value), r"^(\w+)", 1)


def schema_drift(spark: SparkSession, raw: DataFrame, day: Column) -> DataFrame:
    """Keys that the declared schema lacks (``new``) or types otherwise
    (``retyped``), per day."""
    declared = F.create_map(*[F.lit(x) for pair in DECLARED_KEYS.items() for x in pair])
    expected = F.try_element_at(declared, F.col("json_key"))
    return (
        key_types(spark, raw, day)
        .withColumn(
            "finding",
            F.when(expected.isNull(), "new").when(expected != F.col("json_type"), "retyped"),
        )
        .filter(F.col("finding").isNotNull())
    )
