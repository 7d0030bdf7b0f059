"""Captured server-sent event streams: text blocks parted by blank lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changefeed.functions import once


def _field(lines: Column, name: str) -> Column:
    """Values of the lines ``name: value``, leading white space removed."""
    mine = F.filter(lines, lambda line: line.startswith(f"{name}:"))
    return F.transform(
        mine, lambda line: F.regexp_replace(F.substring(line, len(name) + 2, 2**31 - 1), r"^\s+", "")
    )


def read_captured(
    spark: SparkSession, path: str, stream: bool = False, line_end: str = "\n"
) -> DataFrame:
    """``event_id`` and ``raw_json`` of each block with an id and data.

    Spark splits the files at blank lines itself, so one large capture is read
    by many tasks. Several data lines are joined by a newline; the last id line
    of a block counts; comment blocks have neither and go.
    """
    reader = spark.readStream if stream else spark.read
    blocks = reader.option("lineSep", line_end * 2).text(path)
    lines = F.split("value", r"\r?\n")
    return (
        blocks.select(once(F.struct(_field(lines, "id").alias("ids"), _field(lines, "data").alias("data"))))
        .select(
            F.try_element_at("ids", F.lit(-1)).alias("event_id"),
            F.when(F.size("data") > 0, F.array_join("data", "\n")).alias("raw_json"),
        )
        .filter((F.col("event_id") != "") & F.col("raw_json").isNotNull())
    )


def intake(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split blocks into stamped JSON objects and refused data.

    ``ingested_at`` becomes the last key of the object, so that it wins over an
    earlier one of the same name, as it would in an update of the object.
    """
    checked = blocks.select(
        "*", once(F.struct(F.try_parse_json("raw_json").alias("parsed")))
    )
    is_object = F.coalesce(F.schema_of_variant("parsed").startswith("OBJECT"), F.lit(False))
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    body = F.regexp_replace("raw_json", r"\s*\}\s*$", "")
    comma = F.when(F.trim(body) == "{", F.lit("")).otherwise(F.lit(","))
    stamped = F.concat(body, comma, F.lit('"ingested_at":"'), stamp, F.lit('"}'))
    objects = checked.filter(is_object).select("event_id", stamped.alias("raw_json"))
    refused = checked.filter(~is_object).select("event_id", "raw_json")
    return objects, refused
