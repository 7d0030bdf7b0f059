"""Gold tables as batch jobs: backfill, or other windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefeed.operators.windows import (
    BOTS_SPEC,
    EDITS_SPEC,
    GOLD_SPECS,
    GoldSpec,
    edits_from_bots,
    settled,
)
from changefeed.operators.writes import write_partitioned
from changefeed.sources.tables import read_files


def gold_frames(
    events: DataFrame, late_after: str = "2 minutes", specs: tuple[GoldSpec, ...] = GOLD_SPECS
) -> dict[str, DataFrame]:
    """Every gold table as a query over accepted, deduplicated events."""
    return {spec.table.name: spec.build(events, late_after) for spec in specs}


def rebuild_gold(
    spark: SparkSession,
    bronze: DataFrame,
    out: str,
    late_after: str = "2 minutes",
    watermark: str | None = None,
    lengths: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Write all gold tables anew under ``out`` and return them.

    ``watermark`` keeps to the windows a stream would have closed, ``lengths``
    gives tables other windows. Counts without the bot flag are summed from
    those with it, unless their windows differ, so bronze is read three times,
    never all of its columns.
    """
    lengths = lengths or {}
    tables = {}
    for spec in (BOTS_SPEC, EDITS_SPEC, *GOLD_SPECS[2:]):
        length = lengths.get(spec.table.name, spec.length)
        same_windows = length == lengths.get(BOTS_SPEC.table.name, BOTS_SPEC.length)
        if spec is EDITS_SPEC and same_windows:
            counts = edits_from_bots(tables[BOTS_SPEC.table.name])
        else:
            counts = spec.build(bronze, late_after, length)
            if watermark:
                counts = settled(counts, bronze, watermark)
        path = f"{out}/{spec.table.full_name}"
        write_partitioned(counts, spec.table, path)
        tables[spec.table.name] = read_files(spark, spec.table, path).select(*spec.table.column_names)
    return tables
