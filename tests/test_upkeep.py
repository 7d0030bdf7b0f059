import dataclasses
import datetime as dt
import glob
import hashlib
import os
import re
import shutil
import time

import pytest
from pyspark.sql import functions as F
from changefeed.functions import storage
from changefeed.operators import compaction, compare, exports, rebuild, upkeep, windows
from changefeed.operators.dedup import first_copies
from changefeed.operators.gate import gate
from changefeed.operators.writes import write_partitioned
from changefeed.schema import ALL_TABLES, BOTS, BRONZE, DAY, EDITS, PAGES, create_tables
from changefeed.sources import LogSource, read_table, listed_tables
from changefeed.sources.copies import in_force
from changefeed.sources.tables import read_live
from changefeed.streaming import Pipeline
from conftest import record, utc


def day_record(i, day, feed=None):
    feed = feed or ("busy feed" if i % 3 == 0 else f"w{i % 2}")
    return record(f"d{day}-{i}", f"2024-01-{day:02}T{i % 24:02}:{i % 60:02}:00Z", wiki=feed, title=f"t{i % 5}")


@pytest.fixture
def bronze(spark, log_folder, settings):
    """A live bronze table of three days, and a way to add to it."""

    def add(*files):
        path = log_folder(*files)
        pipe = Pipeline(spark, LogSource(path=path, max_files=1).read(spark), settings)
        for query in pipe.start(BRONZE, available_now=True):
            query.awaitTermination()

    add(*[[day_record(i, day) for i in range(30)] for day in (1, 2, 3)])
    return add


def whole(spark, settings):
    return read_table(spark, settings, BRONZE)


def copies(spark, settings):
    return in_force(spark, settings, BRONZE)


def test_compaction_goes_on_where_it_ended(spark, bronze, settings):
    before = {r.meta_id for r in whole(spark, settings).collect()}
    first = compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 2))
    second = compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 3))
    assert (first.row_count, second.row_count) == (30, 30)
    assert compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 3)) is None
    assert copies(spark, settings) == [first.name, second.name]

    rows = whole(spark, settings).collect()
    assert {r.meta_id for r in rows} == before and len(rows) == 90
    third = compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 4), full=True)
    assert third.row_count == 90 and copies(spark, settings) == [third.name]
    assert compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 4), full=True) is None
    assert sorted(r.meta_id for r in whole(spark, settings).collect()) == sorted(before)
    compacted = glob.glob(f"{first.path}/*/*/*.parquet")
    live = glob.glob(f"{settings.table_path(*BRONZE.full_name.split('.'))}/{DAY}=2024-01-01/*/*.parquet")
    assert len(compacted) == 3 < len(live)


def test_files_of_one_second_are_told_apart_by_name(spark, bronze, settings):
    """All files get one modification time, and more arrive with the same one."""
    live = settings.table_path(*BRONZE.full_name.split("."))
    events = whole(spark, settings)
    events.write.parquet(f"{settings.root}/source")
    events = spark.read.parquet(f"{settings.root}/source")
    flat = dataclasses.replace(settings, root=f"{settings.root}/flat")
    path = flat.table_path(*BRONZE.full_name.split("."))

    def add(rows):
        write_partitioned(rows, BRONZE, path, mode="append")
        for name in glob.glob(f"{path}/*/*/*.parquet"):
            os.utime(name, (1_700_000_000, 1_700_000_000))

    add(events.filter("meta_id LIKE '%1'"))
    compaction.compact(spark, flat, BRONZE, dt.date(2024, 1, 4))
    add(events.filter("meta_id NOT LIKE '%1'"))
    for full in (False, True):
        assert compare.same_rows(whole(spark, flat), events).first().equal
        compaction.compact(spark, flat, BRONZE, dt.date(2024, 1, 4), full=full)
    assert compare.same_rows(whole(spark, flat), events).first().equal and len(copies(spark, flat)) == 1
    assert os.path.isdir(live)


def test_a_copy_that_is_not_in_force_is_not_read(spark, bronze, settings):
    """A run that ends before the switch leaves readers where they were."""
    first = compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 2))
    shutil.copytree(first.path, first.path.replace(first.name, "stopped"))
    assert whole(spark, settings).count() == 90


def test_late_rows_of_compacted_days_stay(spark, log_folder, settings):
    """Rows that arrive for a day already compacted are read before and after
    further compactions, which are incremental first and merge then."""
    wide = dataclasses.replace(settings, horizon="30 days")
    for step, late in enumerate((None, "late1", "late2", "late3")):
        lines = [day_record(i, step + 1) for i in range(5)]
        if late:
            lines.append(record(late, "2024-01-01T00:30:00Z"))
        pipe = Pipeline(spark, LogSource(path=log_folder(lines), max_files=1).read(spark), wide)
        for query in pipe.start(BRONZE, available_now=True):
            query.awaitTermination()
        expected = whole(spark, wide).count()
        upkeep.maintain(spark, wide, dt.datetime.now(dt.timezone.utc), dt.date(2024, 1, step + 2), clean_orphans=True, merge_at=2)
        assert whole(spark, wide).count() == expected
    ids = {r.meta_id for r in whole(spark, wide).collect()}
    assert {"late1", "late2", "late3"} <= ids and len(ids) == 23
    assert len(copies(spark, wide)) <= 2


def test_superseded_copies_expire(spark, bronze, settings):
    made = []
    for day in (2, 3, 4):
        made.append(compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, day), full=True))
    now = dt.datetime.now(dt.timezone.utc)
    report = lambda **limits: compaction.expired_copies(spark, settings, BRONZE, **limits)
    assert report(now=now, keep=2) == []
    later = now + dt.timedelta(hours=25)
    assert report(now=later, keep=5) == []
    assert report(now=later, keep=2) == [made[0].path]
    assert report(now=later, keep=0) == [m.path for m in made[:2]]
    gone = compaction.expire(spark, settings, BRONZE, later, keep=2)
    assert [storage.exists(spark, m.path) for m in made] == [False, True, True]
    assert len(gone) == 1 and whole(spark, settings).count() == 90


def test_time_bounds_prune_days(spark, bronze, settings):
    since, until = utc("2024-01-02T00:00:00"), utc("2024-01-02T12:00:00")
    df = read_table(spark, settings, BRONZE, since, until)
    assert df.count() == sum(1 for i in range(30) if i % 24 < 12)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)
    compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 3))
    assert read_table(spark, settings, BRONZE, since, until).count() == df.count()


def test_orphans(spark, bronze, settings):
    path = settings.table_path(*BRONZE.full_name.split("."))
    known = sorted(glob.glob(f"{path}/{DAY}=2024-01-01/wiki=busy*/*.parquet"))[0]
    stray = known.replace("part-", "part-9")
    shutil.copy(known, stray)
    live = read_live(spark, settings, BRONZE)
    assert live.count() == 90
    found = [r.file_path for r in upkeep.orphan_files(spark, path, BRONZE).collect()]
    assert [os.path.basename(f) for f in found] == [os.path.basename(stray)]
    assert "busy%20feed" in found[0]
    hour = dt.timedelta(hours=1)
    now = dt.datetime.now(dt.timezone.utc)
    assert upkeep.orphan_files(spark, path, BRONZE, now - hour).count() == 0
    assert upkeep.remove_orphans(spark, path, BRONZE, now - hour) == []
    assert upkeep.remove_orphans(spark, path, BRONZE, now + hour) == found
    assert not os.path.exists(stray) and os.path.exists(known)
    assert read_live(spark, settings, BRONZE).count() == 90


def test_file_stats(spark, bronze, settings):
    stats = upkeep.file_stats(read_live(spark, settings, BRONZE), BRONZE.partitions).collect()
    assert sum(r.row_count for r in stats) == 90
    on_disk = glob.glob(f"{settings.table_path(*BRONZE.full_name.split('.'))}/*/*/*.parquet")
    assert sum(r.file_count for r in stats) == sum(r.small_files for r in stats) == len(on_disk)
    assert sum(r.byte_count for r in stats) == sum(map(os.path.getsize, on_disk))


def test_maintain(spark, bronze, settings):
    now = dt.datetime.now(dt.timezone.utc)
    report = {r["table"]: r for r in upkeep.maintain(spark, settings, now, dt.date(2024, 1, 3), clean_orphans=True)}
    assert set(report) == {t.full_name for t in ALL_TABLES}
    assert report[BRONZE.full_name]["copy"].row_count == 60
    assert report[EDITS.full_name]["copy"] is None


def test_day_retention_only_for_batch_tables(spark, bronze, settings, tmp_path):
    with pytest.raises(ValueError):
        upkeep.drop_days(spark, settings.table_path(*BRONZE.full_name.split(".")), dt.date(2024, 1, 2))
    path = str(tmp_path / "batch")
    write_partitioned(whole(spark, settings), BRONZE, path)
    assert len(upkeep.drop_days(spark, path, dt.date(2024, 1, 3))) == 2
    assert spark.read.parquet(path).count() == 30


def test_catalog_tables(spark, bronze, settings):
    create_tables(spark, settings)
    create_tables(spark, settings)
    assert listed_tables(spark, "gold") == sorted(t.name for t in ALL_TABLES if t.namespace == "gold")
    assert spark.table(BRONZE.full_name).count() == 90
    assert spark.table(EDITS.full_name).columns == [c for c in EDITS.column_names if c != "wiki"] + [DAY, "wiki"]
    for table in ALL_TABLES:
        spark.sql(f"DROP TABLE {table.full_name}")


def test_rebuild(spark, bronze, settings, tmp_path):
    events = whole(spark, settings)
    tables = rebuild.rebuild_gold(spark, events, str(tmp_path / "gold"))
    for spec in windows.GOLD_SPECS:
        assert compare.same_rows(tables[spec.table.name], spec.build(events)).first().equal
    other = rebuild.rebuild_gold(
        spark, events, str(tmp_path / "other"), watermark="1 hour", lengths={PAGES.name: "1 day", BOTS.name: "1 hour"}
    )
    days = windows.settled(windows.PAGES_SPEC.build(events, length="1 day"), events, "1 hour")
    assert compare.same_rows(other[PAGES.name], days).first().equal
    minutes = windows.settled(windows.EDITS_SPEC.build(events), events, "1 hour")
    assert compare.same_rows(other[EDITS.name], minutes).first().equal


def test_busy_feed_is_split_in_batch_writes(spark, tmp_path):
    """With a small target size the feed with most rows gets several files."""
    lines = [(day_record(i, 1, "busy" if i % 10 else f"quiet{i // 10 % 20}"),) for i in range(20_000)]
    events = first_copies(gate(spark.createDataFrame(lines, "raw_json string"))[0])
    events.write.parquet(str(tmp_path / "flat"))
    events = spark.read.parquet(str(tmp_path / "flat"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        write_partitioned(events.repartition(8), BRONZE, str(tmp_path / "out"))
    finally:
        spark.conf.unset(key)
    count = lambda feed: len(glob.glob(f"{tmp_path}/out/*/wiki={feed}/*.parquet"))
    assert count("busy") > 1
    # A quiet feed has one file, unless it shares its task with the busy one.
    assert min(count(f"quiet{n}") for n in range(20)) == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20_000


def test_exports(spark, bronze, settings, tmp_path):
    events = whole(spark, settings)
    data_files = lambda name: glob.glob(f"{tmp_path}/{name}/part-*")
    exports.export_parquet(events, str(tmp_path / "auto"))
    exports.export_parquet(events, str(tmp_path / "three"), files=3)
    assert len(data_files("auto")) == 1 and len(data_files("three")) == 3
    assert spark.read.parquet(str(tmp_path / "auto")).count() == 90
    taken = [
        sorted(r.meta_id for r in exports.bronze_sample(df, 20).collect())
        for df in (events, events.repartition(7))
    ]
    by_hash = sorted((r.meta_id for r in events.collect()), key=lambda i: hashlib.md5(i.encode()).hexdigest())
    assert taken[0] == taken[1] == sorted(by_hash[:20])
    assert exports.bronze_sample(events, 1_000).count() == 90
    many = spark.range(20_000).select(F.concat(F.lit("k"), F.when(F.col("id") < 9_000, 0).otherwise(F.col("id"))).alias("meta_id"))
    some = [r.meta_id for r in exports.bronze_sample(many, 3_000).collect()]
    digest = sorted((hashlib.md5(r.meta_id.encode()).hexdigest(), r.meta_id) for r in many.collect())
    assert sorted(some) == sorted(k for _, k in digest[:3_000])
    assert exports.bronze_sample(events, 20, repeatable=False).count() == 20
    exports.export_json_lines(events, str(tmp_path / "lines"), 15)
    assert spark.read.json(str(tmp_path / "lines")).filter("meta.id IS NOT NULL").count() == 15


def test_tables_of_a_catalog_are_discovered(spark, settings):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS gold")
    spark.sql("CREATE NAMESPACE IF NOT EXISTS bronze")
    spark.sql("CREATE TABLE gold.someone_elses (a int) USING parquet")
    try:
        found = upkeep.discovered(spark, dataclasses.replace(settings, catalog="spark_catalog"))
    finally:
        spark.sql("DROP TABLE gold.someone_elses")
    assert "gold.someone_elses" in found and upkeep.discovered(spark, settings) == []


def test_iceberg_statements():
    cutoff = dt.datetime(2024, 1, 2, 3, 4, 5)
    calls = upkeep.iceberg_upkeep("gold.t", "lake", cutoff, keep=5, orphans=True)
    assert [c.split("(")[0] for c in calls] == [
        f"CALL lake.system.{p}" for p in ("expire_snapshots", "remove_orphan_files", "rewrite_data_files")
    ]
    assert "retain_last => 5" in calls[0] and "'2024-01-02 03:04:05'" in calls[0]
    assert "days(event_time), wiki" in BRONZE.create_sql("", catalog="lake")
