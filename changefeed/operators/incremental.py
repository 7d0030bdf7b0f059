"""Gold tables rebuilt where bronze has changed only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings, work_dir
from changefeed.functions import storage
from changefeed.operators.dedup import first_copies
from changefeed.operators.windows import GOLD_SPECS, GoldSpec
from changefeed.operators.writes import write_partitioned
from changefeed.schema import BRONZE, DAY
from changefeed.sources.copies import sources
from changefeed.sources.tables import table_parts


def counted_path(out: str, spec: GoldSpec) -> str:
    return f"{out}/counted/{spec.table.name}"


def changed_partitions(spark: SparkSession, settings: Settings, out: str, spec: GoldSpec) -> DataFrame:
    """(file_path, event_date, wiki) of the bronze files that a gold table has not counted yet.

    An anti-join of two listings: the files there are, and the names kept from
    the runs before.
    """
    files = sources(spark, settings, BRONZE)
    path = counted_path(out, spec)
    if storage.exists(spark, path):
        files = files.join(spark.read.parquet(path), "file_path", "left_anti")
    # The folder's name with its escapes undone, of the URI first, then of Spark's own.
    feed = F.regexp_extract("file_path", rf"/{BRONZE.feed}=([^/]*)/", 1)
    plus = lambda text: F.replace(text, F.lit("+"), F.lit("%2B"))  # noqa: E731 - a plus is itself in a path
    plain = F.url_decode(plus(F.url_decode(plus(feed))))
    return files.select("file_path", DAY, F.when(plain != "__HIVE_DEFAULT_PARTITION__", plain).alias(BRONZE.feed))


def touched(bronze: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of the changed (day, feed) pairs. The days go into the plan as
    values, so other days are not listed; there is one value for each day."""
    days = [r[DAY] for r in changed.select(DAY).distinct().collect()]
    pairs = changed.select(F.col(DAY).alias("_day"), F.col(BRONZE.feed).alias("_feed")).distinct()
    same = F.col(DAY).eqNullSafe(F.col("_day")) & F.col(BRONZE.feed).eqNullSafe(F.col("_feed"))
    return bronze.filter(F.col(DAY).isin(days)).join(pairs, same, "left_semi")


def rebuild_changed(
    spark: SparkSession,
    settings: Settings,
    out: str,
    specs: tuple[GoldSpec, ...] = GOLD_SPECS,
    late_after: str = "2 minutes",
    once: bool = True,
) -> dict[str, DataFrame]:
    """Recount the (day, feed) pairs that new bronze files belong to, and overwrite just those.

    ``settings`` names the bronze, ``out`` the folder of the gold tables.
    All windows of the gold tables lie within a day, so a pair is counted from
    its own rows alone. A run that is stopped leaves the names of its files
    uncounted, and the next one overwrites the same partitions. A file that
    arrives between the listing and the scan is counted by this run and by the
    next. ``once=False`` for a bronze with copies: copies of an event must have
    its day and feed. Returns the changed files of each table.
    """
    found = {}
    for spec in specs:
        path = work_dir(spark, f"changed-{spec.table.name}")
        changed_partitions(spark, settings, out, spec).write.parquet(path)
        changed = spark.read.parquet(path)
        found[spec.table.name] = changed
        if changed.isEmpty():
            continue
        columns = list(dict.fromkeys([*spec.inputs, *([] if once else ["ingested_at"]), DAY, BRONZE.feed]))
        parts = [touched(part.select(*columns), changed) for part in table_parts(spark, settings, BRONZE)]
        rows = reduce(DataFrame.unionByName, parts)
        rows = rows if once else first_copies(rows)
        write_partitioned(spec.build(rows, late_after), spec.table, f"{out}/{spec.table.full_name}", only_given=True)
        changed.select("file_path").write.mode("append").parquet(counted_path(out, spec))
    return found
