"""Declared record layouts and tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changefeed.config import Settings

# Layout handed to the JSON parser. The keys that must be JSON strings are read
# as variants, which keep the type of the token; a string field would turn the
# number 7 into the text '7'.
EVENT_DDL = (
    "meta struct<id: variant, dt: string>, wiki variant, type variant, "
    "title string, user string, bot boolean, server_name string, ingested_at string"
)

# JSON key and type of each declared field, for drift reports.
DECLARED_KEYS = {
    "meta": "OBJECT",
    "meta.id": "STRING",
    "meta.dt": "STRING",
    "wiki": "STRING",
    "type": "STRING",
    "title": "STRING",
    "user": "STRING",
    "bot": "BOOLEAN",
    "server_name": "STRING",
    "ingested_at": "STRING",
}

DAY = "event_date"


@dataclass(frozen=True)
class Table:
    """A day-partitioned table. ``event_date`` is derived from ``time``."""

    namespace: str
    name: str
    columns: str
    time: str
    feed: str | None = "wiki"
    keys: tuple[str, ...] = ()
    # At most a few rows for each minute and feed, whatever the input.
    per_minute: bool = False

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.name}"

    @property
    def partitions(self) -> list[str]:
        return [DAY, self.feed] if self.feed else [DAY]

    @property
    def stored_schema(self) -> str:
        """Partition columns last and in their order. A stream that starts on an
        empty folder knows no partitions yet; its columns must stand where they
        will once there are some."""
        declared = [column.strip() for column in self.columns.split(",")]
        feed = [column for column in declared if column.split()[0] == self.feed]
        return ", ".join([c for c in declared if c not in feed] + [f"{DAY} date"] + feed)

    @property
    def column_names(self) -> list[str]:
        return [column.split()[0] for column in self.columns.split(",")]

    def day(self) -> Column:
        return F.to_date(self.time).alias(DAY)

    def with_day(self, df: DataFrame) -> DataFrame:
        return df.select(*self.column_names, self.day())

    def create_sql(self, location: str, catalog: str | None = None) -> str:
        """DDL for a session catalog (Parquet) or, with ``catalog``, for Iceberg."""
        if catalog:
            layout = f"days({self.time})" + (f", {self.feed}" if self.feed else "")
            return (
                f"CREATE TABLE IF NOT EXISTS {catalog}.{self.full_name} ({self.columns}) "
                f"USING iceberg PARTITIONED BY ({layout})"
            )
        return (
            f"CREATE TABLE IF NOT EXISTS {self.full_name} ({self.columns}, {DAY} date) "
            f"USING parquet PARTITIONED BY ({', '.join(self.partitions)}) "
            f"LOCATION '{location}'"
        )


# Names, columns and types of the tables.
BRONZE = Table(
    "bronze",
    "recentchange",
    "event_time timestamp, ingested_at timestamp, wiki string, type string, title string, "
    "user string, bot boolean, server_name string, meta_id string, raw_json string",
    time="event_time",
    keys=("meta_id",),
)

REJECTS = Table(
    "bronze",
    "rejects",
    "raw_json string, reason string, ingested_at timestamp",
    time="ingested_at",
    feed=None,
)


def _gold(
    name: str, extra: str, count: str, keys: tuple[str, ...], per_minute: bool = True
) -> Table:
    columns = f"window_start timestamp, window_end timestamp, wiki string, {extra}{count} bigint"
    keys = ("window_start", *keys)
    return Table("gold", name, columns, "window_start", keys=keys, per_minute=per_minute)


EDITS = _gold("edits_per_minute_by_wiki", "", "edit_count", ("wiki",))
BOTS = _gold("bot_vs_human_per_minute", "bot boolean, ", "edit_count", ("wiki", "bot"))
PAGES = _gold("top_pages_10min", "title string, ", "edit_count", ("wiki", "title"), False)
LATE = _gold("late_arrivals", "", "late_event_count", ("wiki",))

GOLD = (EDITS, BOTS, PAGES, LATE)
ALL_TABLES = (BRONZE, *GOLD, REJECTS)


def create_tables(spark: SparkSession, settings: Settings) -> None:
    """Create the namespaces and every table that is absent."""
    for namespace in sorted({t.namespace for t in ALL_TABLES}):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {settings.table_name(namespace)}")
    for table in ALL_TABLES:
        path = settings.table_path(table.namespace, table.name)
        spark.sql(table.create_sql(path, settings.catalog))
