"""Rebuilds of what changed, first loads, comparison by digests, sketches, sessions, footers, rankings."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from changefeed.operators import compaction, compare, incremental, percentiles, quality, sketches, windows
from changefeed.operators.gate import gate
from changefeed.operators.writes import write_partitioned
from changefeed.schema import BRONZE, DAY, EDITS, REJECTS
from changefeed.sources import LogSource, read_table
from changefeed.sources.copies import LOADED, in_force
from changefeed.sources.tables import read_files
from changefeed.streaming import Pipeline, ranking, state
from changefeed.streaming.handover import boundary, first_load
from conftest import record


def day_record(i, day, feed=None, **changes):
    feed = feed or ("busy feed+%" if i % 3 == 0 else f"w{i % 2}")
    return record(f"d{day}-{i}", f"2024-01-{day:02}T{i % 24:02}:{i % 60:02}:00Z", wiki=feed, title=f"t{i % 5}", **changes)


def accepted(spark, lines):
    return gate(spark.createDataFrame([(line,) for line in lines], "raw_json string"))[0]


@pytest.fixture
def bronze(spark, settings):
    path = settings.table_path(BRONZE.namespace, BRONZE.name)
    return lambda lines: write_partitioned(accepted(spark, lines), BRONZE, path, mode="append")


def gold(spark, out):
    return {s.table.name: read_files(spark, s.table, f"{out}/{s.table.full_name}").select(*s.table.column_names) for s in windows.GOLD_SPECS}


def test_rebuild_changed_equals_a_full_rebuild(spark, bronze, settings, tmp_path):
    out = str(tmp_path / "gold")
    late = {"ingested_at": "2024-02-01T00:00:00Z"}
    steps = [
        [day_record(i, day, **(late if i % 7 == 0 else {})) for day in (1, 2, 3) for i in range(20)],
        [day_record(100 + i, 4) for i in range(5)] + [day_record(200, 1, "w1", **late)],
        [],
        [day_record(300, 2, "a new feed", **late)],
    ]
    wanted = [{(d, w) for d in (1, 2, 3) for w in ("busy feed+%", "w0", "w1")}, {(4, "busy feed+%"), (4, "w0"), (4, "w1"), (1, "w1")}, set(), {(2, "a new feed")}]
    for lines, pairs in zip(steps, wanted, strict=True):
        if lines:
            bronze(lines)
        found = incremental.rebuild_changed(spark, settings, out)
        events = read_table(spark, settings, BRONZE)
        for spec in windows.GOLD_SPECS:
            assert compare.same_rows(gold(spark, out)[spec.table.name], spec.build(events)).first().equal
            touched = {(r[DAY].day, r.wiki) for r in found[spec.table.name].collect()}
            assert touched == pairs


def test_the_scan_reads_touched_days_only(spark, bronze, settings, tmp_path):
    out = str(tmp_path / "gold")
    bronze([day_record(i, day) for day in (1, 2, 3) for i in range(20)])
    incremental.rebuild_changed(spark, settings, out)
    bronze([day_record(99, 2, "w1")])
    changed = incremental.changed_partitions(spark, settings, out, windows.EDITS_SPEC)
    rows = incremental.touched(read_files(spark, BRONZE, settings.table_path(BRONZE.namespace, BRONZE.name)), changed)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*2024-01-02", plan)
    # All of that day and feed is read again, nothing else.
    assert {(r[DAY].day, r.wiki) for r in rows.collect()} == {(2, "w1")}
    assert rows.count() == 1 + sum(1 for i in range(20) if i % 3 and i % 2)


def test_a_stopped_run_is_repeated(spark, bronze, settings, tmp_path, monkeypatch):
    out = str(tmp_path / "gold")
    bronze([day_record(i, 1) for i in range(10)])
    real = incremental.write_partitioned

    def stopped(*args, **named):
        real(*args, **named)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "write_partitioned", stopped)
    with pytest.raises(RuntimeError):
        incremental.rebuild_changed(spark, settings, out)
    monkeypatch.setattr(incremental, "write_partitioned", real)
    incremental.rebuild_changed(spark, settings, out)
    events = read_table(spark, settings, BRONZE)
    assert compare.same_rows(gold(spark, out)[EDITS.name], windows.EDITS_SPEC.build(events)).first().equal


def test_rebuild_of_a_bronze_with_copies(spark, bronze, settings, tmp_path):
    out = str(tmp_path / "gold")
    lines = [day_record(i, 1) for i in range(10)]
    bronze(lines)
    incremental.rebuild_changed(spark, settings, out, once=False)
    bronze(lines[:4])
    incremental.rebuild_changed(spark, settings, out, once=False)
    assert gold(spark, out)[EDITS.name].agg(F.sum("edit_count")).first()[0] == 10


def test_first_load_and_take_over(spark, log_folder, settings, tmp_path):
    path = log_folder([day_record(i, 1) for i in range(20)] + ["not json"], [day_record(i, 2) for i in range(20)])
    source = LogSource(path=path, max_files=1)
    made = first_load(spark, settings, source)
    assert (made[BRONZE.name].row_count, made[REJECTS.name].row_count) == (40, 1)
    with pytest.raises(ValueError):
        first_load(spark, settings, source)
    # What lies near the newest loaded event is known to the streams; copies of it do not get in again.
    assert [r.meta_id for r in boundary(spark, settings).collect()]
    newest = max(boundary(spark, settings).collect(), key=lambda r: r.event_time)
    again = next(line for line in [day_record(i, 2) for i in range(20)] if f'"{newest.meta_id}"' in line)
    log_folder([again, day_record(50, 3), "[]"], [day_record(51, 3)])
    pipeline = Pipeline(spark, source.read(spark), settings)
    for query in pipeline.start(BRONZE, REJECTS, available_now=True):
        query.awaitTermination()
        assert sum(p.numInputRows for p in query.recentProgress) == 4
    ids = [r.meta_id for r in pipeline.table(BRONZE).collect()]
    assert len(ids) == len(set(ids)) == 42 and {"d3-50", "d3-51"} <= set(ids)
    assert pipeline.table(REJECTS).count() == 2
    # Loaded rows are counted, and compaction leaves their copy alone.
    out = str(tmp_path / "gold")
    incremental.rebuild_changed(spark, settings, out, (windows.EDITS_SPEC,))
    counts = read_files(spark, EDITS, f"{out}/{EDITS.full_name}").agg(F.sum("edit_count")).first()[0]
    assert counts == 42
    compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 9))
    compaction.compact(spark, settings, BRONZE, dt.date(2024, 1, 9), full=True)
    assert f"{LOADED}first" in in_force(spark, settings, BRONZE) and pipeline.table(BRONZE).count() == 42


def test_first_load_of_an_empty_log(spark, tmp_path, settings):
    (tmp_path / "empty").mkdir()
    assert first_load(spark, settings, LogSource(path=str(tmp_path / "empty"))) == {}
    assert boundary(spark, settings) is None


@pytest.mark.parametrize("seed", range(3))
def test_difference_levels_equals_difference(spark, tmp_path, seed):
    rng = random.Random(seed)
    lines = [day_record(i, day) for day in (1, 2, 3, 4) for i in range(30)]
    source = accepted(spark, lines)
    lost = {f"d{rng.choice((2, 4))}-{rng.randrange(30)}" for _ in range(4)}
    other = source.filter(~F.col("meta_id").isin(*lost)).withColumn("raw_json", F.when(F.col("meta_id") == f"d2-{seed}", "x").otherwise(F.col("raw_json")))
    extra = source.filter(F.col("meta_id") == "d4-7")
    tables, kept = [], []
    for k, rows in enumerate((source, other.unionByName(extra))):
        write_partitioned(rows, BRONZE, str(tmp_path / f"t{k}"))
        tables.append(read_files(spark, BRONZE, str(tmp_path / f"t{k}")))
        compare.digests(tables[-1], DAY, "meta_id", BRONZE.column_names, 8).write.parquet(str(tmp_path / f"k{k}"))
        kept.append(spark.read.parquet(str(tmp_path / f"k{k}")))
    found = compare.difference_levels(*tables, *kept, DAY, "meta_id", BRONZE.column_names, 8)
    plain = compare.difference(*tables, BRONZE.column_names)
    key = lambda r: (r.meta_id, r.raw_json, r.surplus)
    assert sorted(map(key, found.collect())) == sorted(map(key, plain.collect())) != []
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    days = set(re.findall(r"2024-01-0\d", plan)) or {str(dt.date(1970, 1, 1) + dt.timedelta(int(d))) for d in re.findall(r"event_date#\d+ IN \(([^)]*)\)", plan)[0].split(",")}
    assert "2024-01-01" not in days and "2024-01-03" not in days
    same = compare.difference_levels(tables[0], tables[0], kept[0], kept[0], DAY, "meta_id", BRONZE.column_names, 8)
    assert same.collect() == []


def test_sketches_merge_to_any_span(spark, tmp_path):
    n = 60_000
    rows = spark.range(n).select(
        F.timestamp_micros(F.lit(1704067200000000) + (F.col("id") % 30) * F.lit(86_400_000_000)).alias("event_time"),
        F.when(F.col("id") % 3 == 0, "busy").otherwise(F.concat(F.lit("w"), F.col("id") % 5)).alias("wiki"),
        F.concat(F.lit("k"), F.col("id") % 20_000).alias("meta_id"),
        ((F.col("id") * 7919) % 10_007).alias("value"),
    )
    kept = sketches.day_sketches(rows, F.col("value"), "wiki")
    kept.write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    bound = sketches.rank_bound()
    values = {}
    for r in rows.filter("event_time < '2024-01-21'").select("wiki", "value", "meta_id").collect():
        values.setdefault(r.wiki, []).append((r.value, r.meta_id))
    merged = sketches.merged(kept, ["wiki"], dt.date(2024, 1, 1), dt.date(2024, 1, 21))
    for r in sketches.percentiles_of(merged, ["wiki"]).collect():
        own = [v for v, _ in values[r.wiki]]
        assert r.event_count == len(own)
        assert sum(v < r.value for v in own) / len(own) <= r.point + bound and sum(v <= r.value for v in own) / len(own) >= r.point - bound
    for r in sketches.distinct_of(merged, ["wiki"]).collect():
        exact = len({k for _, k in values[r.wiki]})
        assert abs(r.distinct_keys - exact) <= 0.03 * exact
    exact = percentiles.exact_percentiles(rows, F.col("value"), "wiki").filter("point = 0.5").count()
    assert exact == len(values)


def test_sessions_merge_across_batches(spark, log_folder, settings, tmp_path):
    """An event between two sessions makes them one, also when it comes a batch later."""
    at = lambda i, minute: record(f"e{i}", f"2024-01-01T{minute // 60:02}:{minute % 60:02}:00Z", user="u")
    path = log_folder([at(1, 0), at(2, 40)], [at(3, 20)], [at(4, 300), at(5, 301)], [at(6, 900)])
    pipeline = Pipeline(spark, LogSource(path=path, max_files=1).read(spark), settings)
    found = windows.sessions(pipeline.events("2 hours", ["meta_id", "event_time", "user"]), "25 minutes", ["user"])
    query = found.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query.format("parquet").start(str(tmp_path / "out")).awaitTermination()
    rows = sorted((r.session_start.hour * 60 + r.session_start.minute, r.event_count) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows == [(0, 3), (300, 2)]
    batch = windows.sessions(accepted(spark, [at(i, m) for i, m in enumerate((0, 40, 20, 300, 301, 900))]), "25 minutes", ["user"])
    assert sorted(r.event_count for r in batch.collect()) == [1, 2, 3]


def test_counts_come_from_footers(spark, tmp_path):
    write_partitioned(accepted(spark, [day_record(i, 1 + i % 3) for i in range(30)]), BRONZE, str(tmp_path / "t"))
    counts = quality.footer_counts(spark, str(tmp_path / "t"), BRONZE.stored_schema, BRONZE.partitions)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [event_date, wiki]" in plan
    assert sum(r.row_count for r in counts.collect()) == 30
    # The settings of the caller's session stay.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_kept_ids(spark, log_folder, settings):
    path = log_folder([day_record(i, 1) for i in range(5)], [record("new", "2024-01-02T12:00:00Z")])
    pipeline = Pipeline(spark, LogSource(path=path, max_files=1).read(spark), settings)
    for query in pipeline.start(BRONZE, available_now=True):
        query.awaitTermination()
    kept = state.kept_ids(spark, settings, BRONZE.name).collect()
    assert [(r.meta_id, r.expires_at.minute) for r in kept] == [("new", 2)]
    assert sum(r.key_count for r in state.state_sizes(spark, settings, BRONZE.name).collect()) == 1
    assert state.state_operators(spark, settings, BRONZE.name).first().numPartitions == settings.state_partitions


def test_ranking_is_the_same_after_a_replay(spark, tmp_path):
    rng = random.Random(4)
    counts, path = {}, str(tmp_path / "ranking")
    (tmp_path / "ranking").mkdir()
    schema = "window_start timestamp, window_end timestamp, wiki string, title string, edit_count bigint"
    begin = lambda w: dt.datetime(2024, 1, 1 + w // 3, w % 3, tzinfo=dt.timezone.utc)
    for _ in range(6):
        touched = set()
        for _ in range(30):
            key = (rng.randrange(6), rng.choice(["a", None]), rng.choice([*"pqrst", None]))
            counts[key] = counts.get(key, 0) + 1
            touched.add(key)
        rows = [(begin(w), begin(w) + dt.timedelta(hours=1), wiki, title, counts[(w, wiki, title)]) for w, wiki, title in touched]
        batch = spark.createDataFrame(rows, schema)
        for _ in range(2):
            ranking.merge_ranking(batch, path, 2)
    everything = [(begin(w), begin(w) + dt.timedelta(hours=1), wiki, title, n) for (w, wiki, title), n in counts.items()]
    wanted = windows.top_pages(spark.createDataFrame(everything, schema), 2)
    got = ranking.read_ranking(spark, path)
    assert compare.same_rows(got.select(*wanted.columns), wanted).first().equal
    assert got.count() == wanted.count() == len({(w, k) for w, k, _ in counts}) * 2 - sum(1 for x in {(w, k) for w, k, _ in counts} if sum(1 for w, k, _ in counts if (w, k) == x) < 2)


def test_filters_leave_out_no_id_that_was_seen(spark):
    """Against a plain join; the few false hits of the filters end at the exact check."""
    from changefeed.operators import seen

    history = spark.range(4_000).select(F.concat(F.lit("k"), F.col("id") % 1_500).alias("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("day"))
    history = history.unionByName(spark.createDataFrame([(None, dt.date(2024, 1, 1))], history.schema))
    new = spark.range(3_000).select(F.concat(F.lit("k"), F.col("id") * 3).alias("id")).unionByName(spark.createDataFrame([(None,)], "id string"))
    filters = seen.day_filters(history, "id", "day", 4)
    plain = history.join(new, "id", "left_semi").distinct()
    pairs = {(r.h, r.day) for r in seen.candidates(new, "id", filters, 4).collect()}
    exact = {(r.h, r.day) for r in plain.select(seen.id_hash("id").alias("h"), "day").collect()}
    assert exact <= pairs and len(pairs) <= len(exact) + 0.02 * 7 * 3_000
    assert compare.same_rows(seen.seen_before(new, history, filters, "id", "day", 4), plain).first().equal
    empty = seen.day_filters(history.limit(0), "id", "day", 4)
    assert seen.seen_before(new, history.limit(0), empty, "id", "day", 4).collect() == []


def test_a_silent_feed_is_told_and_so_is_its_return(spark, log_folder, settings, tmp_path):
    import time

    from changefeed.streaming.silence import SILENCE_DDL, silent_feeds

    path = log_folder([day_record(0, 1, "a"), day_record(1, 1, "b")])
    found = silent_feeds(gate(LogSource(path=path).read(spark))[0], 6)
    writer = found.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second")
    query = writer.format("parquet").start(str(tmp_path / "out"))
    told = lambda: [(r.feed, r.silent) for r in spark.read.schema(SILENCE_DDL).parquet(str(tmp_path / "out")).orderBy("at").collect()]
    try:
        until = time.time() + 120
        # Nothing arrives any more, and both are told to be silent.
        while time.time() < until and len(told()) < 2:
            time.sleep(1)
        assert sorted(told()) == [("a", True), ("b", True)]
        log_folder([day_record(2, 1, "b")])
        while time.time() < until and ("b", False) not in told():
            time.sleep(1)
        assert ("b", False) in told()[2:]
    finally:
        query.stop()
