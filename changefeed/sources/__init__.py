from changefeed.sources.captured import intake, read_captured
from changefeed.sources.events import change_log, read_events, stream_events
from changefeed.sources.log import LogSource, keyed, land, rows_per_partition, sample
from changefeed.sources.tables import read_table, listed_tables

__all__ = [
    "LogSource",
    "change_log",
    "intake",
    "keyed",
    "land",
    "read_captured",
    "read_events",
    "read_table",
    "rows_per_partition",
    "sample",
    "stream_events",
    "listed_tables",
]
