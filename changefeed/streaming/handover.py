"""A first load in batch, and the streams that go on from there.

Streams first record the files of the log as read without opening one. Those
very files, by the names in the stream's own log, are then loaded in batch:
nothing is read twice or left out, whatever arrives meanwhile. Loaded rows are
a copy next to the live table, so readers see both.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings, work_dir
from changefeed.functions import storage
from changefeed.operators.compaction import Copy, add_copy
from changefeed.operators.dedup import first_copies
from changefeed.operators.gate import judged
from changefeed.schema import BRONZE, REJECTS, Table
from changefeed.sources.copies import LOADED
from changefeed.sources.log import LogSource


def boundary_path(settings: Settings) -> str:
    return f"{settings.root}/handover/newest"


def boundary(spark: SparkSession, settings: Settings) -> DataFrame | None:
    """(meta_id, event_time, mark): the loaded events within the horizon of the newest one; None without a load."""
    path = boundary_path(settings)
    return spark.read.parquet(path) if storage.exists(spark, path) else None


def behind_load(events: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Events of the log as a stream would go on with them after the loaded ones.

    It would have dropped what lies behind its watermark, and copies of events
    within the horizon. Their ids are the static side of the join; they are as
    many as the deduplication keeps in its state anyway.
    """
    if loaded is None:
        return events
    mark = loaded.select("mark").limit(1).scalar()
    newer = events.filter(F.coalesce(F.col("event_time") > mark, F.lit(True)))
    return newer.join(loaded.select("meta_id"), "meta_id", "left_anti")


def seen_files(spark: SparkSession, settings: Settings, table: Table) -> list[str]:
    """The log's files that a stream has recorded, from the log of its source."""
    lines = spark.read.text(f"{settings.checkpoint(table.name)}/sources/0").filter(F.col("value").startswith("{"))
    names = lines.select(F.get_json_object("value", "$.path").alias("path")).distinct()
    return sorted(unquote(r.path) for r in names.toLocalIterator())


def first_load(spark: SparkSession, settings: Settings, source: LogSource) -> dict[str, Copy]:
    """Load a file log's present files into bronze and rejects, in batch; streams started later read what follows.

    To be run before the first start of the streams. If it is stopped, it can
    be run again: files seen by then are loaded, none twice, since a copy
    counts only once it is in force. Gold tables follow from
    ``rebuild_changed``. A Kafka log needs no such load: its streams take
    starting offsets.
    """
    from changefeed.streaming.pipeline import Pipeline

    if source.format == "kafka":
        raise ValueError("give the streams starting offsets instead")
    if boundary(spark, settings) is not None:
        raise ValueError(f"{settings.root} has been loaded before")
    unread = Pipeline(spark, source.read(spark, unread=True), settings)
    for query in unread.start(BRONZE, REJECTS, available_now=True):
        query.awaitTermination()
    files = {table: seen_files(spark, settings, table) for table in (BRONZE, REJECTS)}
    parts, done, name = {}, {}, f"{LOADED}first"
    for table in files:
        # One parse serves both, unless a file came between the starts of the two streams.
        same = tuple(files[table])
        if same not in parts:
            path = work_dir(spark, "judged")
            if same:
                judged(source.read(spark, stream=False, files=list(same))).write.partitionBy("rejected").parquet(path)
            parts[same] = path
        if not same:
            continue
        rows = spark.read.parquet(parts[same]).filter(F.col("rejected") == (table is REJECTS)).select(*table.column_names)
        if table is BRONZE and settings.bronze == "once":
            rows = first_copies(rows)
        path = work_dir(spark, f"load-{table.name}")
        rows.write.parquet(path)
        rows = spark.read.parquet(path)
        done[table.name] = add_copy(spark, settings, table, name, rows, instead_of=[name])
        if table is BRONZE:
            newest = rows.agg((F.max("event_time") - F.expr(f"INTERVAL {settings.horizon}")).alias("mark"))
            found = rows.select("meta_id", "event_time").withColumn("mark", newest.scalar())
            near = found.filter(F.col("event_time") > F.col("mark"))
    if done:
        # Last: from now on streams may start.
        near.write.parquet(boundary_path(settings))
    return done
