"""Compaction as a batch rewrite, and first loads that a stream takes over from.

Files of a live table are never rewritten in place, because the log of the sink
names them. A run copies the rows of closed days whose files no copy holds, in
files of a good size, checks the copy and switches readers to it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefeed.config import Settings
from changefeed.functions import storage
from changefeed.operators.compare import fingerprint
from changefeed.operators.writes import write_partitioned
from changefeed.schema import DAY, Table
from changefeed.sources import copies as c
from changefeed.sources.tables import read_files


@dataclass(frozen=True)
class Copy:
    name: str
    path: str
    row_count: int


def add_copy(spark: SparkSession, settings: Settings, table: Table, name: str, rows: DataFrame, instead_of: list[str] | None = None) -> Copy:
    """Write ``rows`` as a copy, check it, and put it in force, some others out of it."""
    path = f"{c.rows_path(settings, table)}/copy={name}"
    rows = table.with_day(rows)
    write_partitioned(rows, table, path)
    columns = [*table.column_names, DAY]
    wanted = fingerprint(rows, columns).first()
    written = fingerprint(read_files(spark, table, path), columns).first()
    if wanted != written:
        raise RuntimeError(f"{table.full_name}: {written} copied, expected {wanted}")
    present = c.in_force(spark, settings, table)
    c.switch(spark, settings, table, [*[x for x in present if x not in (instead_of or [])], name])
    return Copy(name, path, written.row_count)


def compact(spark: SparkSession, settings: Settings, table: Table, through: dt.date, full: bool = False) -> Copy | None:
    """Copy what closed days have in loose files.

    A run takes the files that no copy holds, so each is rewritten once;
    ``full`` also merges the copies so far into one, but for loaded ones, whose
    files are of a good size already. None without anything to copy.
    """
    present = [x for x in c.in_force(spark, settings, table) if not x.startswith(c.LOADED)]
    name = uuid.uuid4().hex
    # Written before the rows are: files that a commit adds meanwhile are not among them.
    path = f"{c.held_path(settings, table)}/copy={name}"
    files = c.loose(spark, settings, table, present).filter(F.col(DAY) < F.lit(through))
    if full:
        files = files.unionByName(c.held(spark, settings, table, present).drop("copy"))
    files.coalesce(1).write.parquet(path)
    files = c.held(spark, settings, table, [name])
    new = files.join(c.held(spark, settings, table, present), "file_path", "left_anti")
    if new.isEmpty() and not (full and len(present) > 1):
        storage.delete(spark, path)
        return None
    rows = c.read_named(spark, settings, table, new)
    if full and present:
        rows = rows.unionByName(c.read_copies(spark, settings, table, present))
    return add_copy(spark, settings, table, name, rows, instead_of=present if full else [])


def expired_copies(
    spark: SparkSession,
    settings: Settings,
    table: Table,
    now: dt.datetime,
    keep: int = 5,
    older_than: dt.timedelta = dt.timedelta(hours=24),
) -> list[str]:
    """Folders of copies that neither the newest ``keep`` switches nor the present one name, past the age limit."""
    known = c.switches(spark, settings, table)
    in_use = {name for s in known[len(known) - max(1, keep) if keep < len(known) else 0 :] for name in s.copies}
    begun = {}
    for s in known:
        for name in s.copies:
            begun.setdefault(name, s.created_at)
    cutoff = _utc(now) - older_than
    old = [f"{c.rows_path(settings, table)}/copy={n}" for n, at in begun.items() if n not in in_use and _utc(at) < cutoff]
    return [path for path in old if storage.exists(spark, path)]


def expire(spark: SparkSession, settings: Settings, table: Table, now: dt.datetime, **limits) -> list[str]:
    """Delete what :func:`expired_copies` reports."""
    paths = expired_copies(spark, settings, table, now, **limits)
    for path in paths:
        storage.delete(spark, path)
    return paths


def _utc(moment: dt.datetime) -> dt.datetime:
    """Times that ``collect`` returns are in the driver's zone, without saying so."""
    return moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
