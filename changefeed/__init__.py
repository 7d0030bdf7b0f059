"""Spark-native analytics for feeds of JSON change events."""

from changefeed.config import Settings, prepare_session, work_dir
from changefeed.schema import BRONZE, GOLD, REJECTS, Table

__all__ = ["BRONZE", "GOLD", "REJECTS", "Settings", "Table", "prepare_session", "work_dir"]
