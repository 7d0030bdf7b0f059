"""What a streaming query keeps, read from its checkpoint as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings


def state_operators(spark: SparkSession, settings: Settings, query: str) -> DataFrame:
    """The stateful operators of a query: id, name, store, partitions, batches kept."""
    return spark.read.format("state-metadata").load(settings.checkpoint(query))


def state_rows(spark: SparkSession, settings: Settings, query: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(key, value, partition_id) of a stateful operator, as of its last batch or an earlier one."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(settings.checkpoint(query))


def kept_ids(spark: SparkSession, settings: Settings, query: str) -> DataFrame:
    """(meta_id, expires_at): the ids that deduplication still knows, and the watermark at which it forgets them."""
    rows = state_rows(spark, settings, query)
    key, value = (rows.schema[c].dataType.fieldNames()[0] for c in ("key", "value"))
    return rows.select(F.col(f"key.{key}").alias("meta_id"), F.timestamp_micros(F.col(f"value.{value}")).alias("expires_at"))


def state_sizes(spark: SparkSession, settings: Settings, query: str) -> DataFrame:
    """Keys in each state partition: a hot partition shows here."""
    return state_rows(spark, settings, query).groupBy("partition_id").agg(F.count(F.lit(1)).alias("key_count"))
