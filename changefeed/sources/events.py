"""Change events made from an ``events`` table.

The table is clean; copies, late arrivals and broken records are added by
arithmetic on ``event_id``, so that another engine can tell what must come out
of the pipeline without parsing any JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.functions import storage

# The ``events`` table.
EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_events(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{directory}/events.parquet")


def stream_events(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of files."""
    reader = spark.readStream.schema(EVENTS_DDL).options(**options)
    path = f"{directory}/events.parquet"
    if storage.is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(directory)


def change_log(events: DataFrame) -> DataFrame:
    """The raw log: ``raw_json`` and ``arrived_at``, with faults and copies."""
    fault = F.col("event_id") % 101
    iso = lambda time: F.date_format(time, ISO)
    arrived = F.col("ts").cast("timestamp") + F.make_dt_interval(
        secs=((F.col("event_id") * 37) % 150).cast("decimal(18,6)")
    )
    wiki = F.concat(F.lit("wiki"), (F.col("user_id") % 6).cast("string"))
    quoted = lambda key, value: F.concat(F.lit(f'"{key}":"'), value, F.lit('"'))
    bare = lambda key, value: F.concat(F.lit(f'"{key}":'), value.cast("string"))

    meta = F.concat(
        F.lit('"meta":{'),
        F.when(fault == 9, F.lit('"origin":{"n":1},')).otherwise(F.lit("")),
        F.when(fault == 2, bare("id", F.col("event_id"))).otherwise(
            quoted("id", F.concat(F.lit("evt-"), F.col("event_id").cast("string")))
        ),
        F.lit(","),
        quoted("dt", F.when(fault == 3, F.lit("bad")).otherwise(iso("ts"))),
        F.lit("}"),
    )
    members = [
        meta,
        # concat_ws leaves out nulls, that is, the absent keys.
        F.when(fault == 6, quoted("wiki", F.lit("  "))).when(fault != 4, quoted("wiki", wiki)),
        F.when(fault == 5, bare("type", F.lit(5))).otherwise(quoted("type", F.col("event_type"))),
        quoted("title", F.concat(F.lit("page-"), F.get_json_object("props", "$.k"))),
        quoted("user", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        F.when(fault != 7, bare("bot", F.col("user_id") % 10 == 0)),
        quoted("server_name", F.concat(wiki, F.lit(".example.org"))),
        quoted("ingested_at", iso(arrived)),
    ]
    text = (
        F.when(fault == 0, F.lit("not json"))
        .when(fault == 1, F.lit(""))
        .when(fault == 8, F.lit("[]"))
        .otherwise(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")))
    )
    deliveries = F.when(F.col("event_id") % 50 == 0, 2).otherwise(1)
    return (
        events.select(text.alias("raw_json"), arrived.alias("arrived_at"), deliveries.alias("n"))
        .select("raw_json", "arrived_at", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
        .drop("copy")
    )
