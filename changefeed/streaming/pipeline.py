"""The standing pipeline: log to rejects and bronze, bronze to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changefeed.config import Settings, prepare_session
from changefeed.functions import storage
from changefeed.operators.dedup import dedup_stream
from changefeed.operators.gate import gate
from changefeed.operators.windows import GOLD_SPECS, LATE_SPEC, GoldSpec
from changefeed.schema import ALL_TABLES, BRONZE, GOLD, REJECTS, Table
from changefeed.sources.tables import read_table, stream_table
from changefeed.streaming.handover import behind_load, boundary
from changefeed.streaming.metrics import METRICS_DDL, progress_row
from changefeed.streaming.sinks import append_to_table

SHUFFLE_WIDTH = "spark.sql.shuffle.partitions"


class Pipeline:
    """Six streaming queries over one log, each with its own checkpoint.

    Bronze parses and deduplicates once; three gold queries read it. The late
    count reads the log itself, because an event that is late for bronze has
    already been dropped there.
    """

    def __init__(self, spark: SparkSession, raw: DataFrame, settings: Settings):
        self.spark = prepare_session(spark)
        self.settings = settings
        self.accepted, self.rejected = gate(raw)
        self.loaded = boundary(spark, settings)
        self.queries: dict[str, StreamingQuery] = {}
        if not settings.in_catalog:
            for table in ALL_TABLES:
                storage.make_folder(spark, settings.table_path(table.namespace, table.name))

    def events(self, horizon: str, columns: list[str]) -> DataFrame:
        """Accepted events, each id once, with no more columns than needed."""
        return dedup_stream(
            behind_load(self.accepted, self.loaded).select(*columns), horizon=horizon, collapse=self.settings.collapse_copies
        )

    def gold_input(self, spec: GoldSpec) -> DataFrame:
        if spec is LATE_SPEC:
            return self.events(self.settings.late_horizon, spec.inputs)
        if self.settings.gold_from == "source":
            return self.events(self.settings.watermark, spec.inputs)
        bronze = stream_table(self.spark, self.settings, BRONZE)
        if self.settings.bronze == "all":
            return dedup_stream(
                bronze.select(*spec.inputs),
                horizon=self.settings.watermark,
                collapse=self.settings.collapse_copies,
            )
        return bronze.withWatermark("event_time", self.settings.watermark)

    def frame(self, table: Table) -> DataFrame:
        """The stream that feeds a table."""
        if table is REJECTS:
            return self.rejected
        if table is BRONZE and self.settings.bronze == "all":
            return behind_load(self.accepted, self.loaded).select(*BRONZE.column_names)
        if table is BRONZE:
            return self.events(self.settings.horizon, BRONZE.column_names)
        spec = next(s for s in GOLD_SPECS if s.table is table)
        return spec.build(self.gold_input(spec), self.settings.late_after)

    def start(self, *tables: Table, available_now: bool = False) -> list[StreamingQuery]:
        width = self.settings.width(self.spark)
        session_width = self.spark.conf.get(SHUFFLE_WIDTH)
        # A query keeps the settings of the moment it starts.
        self.spark.conf.set(SHUFFLE_WIDTH, width)
        try:
            started = {
                table.name: append_to_table(self.frame(table), table, self.settings, available_now)
                for table in tables or ALL_TABLES
            }
        finally:
            self.spark.conf.set(SHUFFLE_WIDTH, session_width)
        self.queries.update(started)
        return list(started.values())

    def run_available(self) -> dict[str, StreamingQuery]:
        """Process what the log holds and stop; bronze first, since gold reads it."""
        for step in ((BRONZE, REJECTS), GOLD):
            for query in self.start(*step, available_now=True):
                query.awaitTermination()
        return dict(self.queries)

    def await_any(self) -> None:
        """Until one query ends; its failure is raised here."""
        self.spark.streams.awaitAnyTermination()

    def stop(self) -> None:
        for query in self.queries.values():
            query.stop()

    def table(self, table: Table) -> DataFrame:
        return read_table(self.spark, self.settings, table)

    def progress(self) -> DataFrame:
        """The batches that the queries still remember, as metrics rows."""
        rows = [progress_row(p) for q in self.queries.values() for p in q.recentProgress]
        return self.spark.createDataFrame(rows, METRICS_DDL)
