import random
import time

import pytest
from pyspark.sql import functions as F

from changefeed.config import Settings
from changefeed.functions import storage
from changefeed.operators import compare, windows
from changefeed.operators.dedup import first_copies
from changefeed.operators.gate import gate
from changefeed.schema import BOTS, BRONZE, EDITS, GOLD, LATE, PAGES, REJECTS
from changefeed.sources import LogSource
from changefeed.streaming import Pipeline, ProgressRecorder, metrics, overwrite_batches
from conftest import record


def at(minute_second, event_id, **changes):
    minute, second = map(int, minute_second.split(":"))
    return record(str(event_id), f"2024-01-01T00:{minute:02}:{second:02}Z", **changes)


def pipeline(spark, path, settings, **options):
    return Pipeline(spark, LogSource(path=path, **options).read(spark), settings)


def run(pipe, *tables):
    for query in pipe.start(*tables, available_now=True):
        query.awaitTermination()
    return pipe


def counts(df, value="edit_count"):
    return {r.m: r[value] for r in df.select(F.minute("window_start").alias("m"), value).collect()}


LATENESS = [
    [at("0:10", 1), at("0:20", 2), at("0:10", 1)],
    [at("5:00", 3), at("0:10", 1)],
    [at("0:30", 4), at("5:30", 5), at("0:20", 2)],
    [at("20:00", 6)],
]


@pytest.mark.parametrize("collapse", [True, False])
def test_lateness_is_judged_by_the_batch_before(spark, log_folder, settings, collapse):
    import dataclasses

    settings = dataclasses.replace(settings, gold_from="source", collapse_copies=collapse)
    pipe = run(pipeline(spark, log_folder(*LATENESS), settings, max_files=1), BRONZE, EDITS)
    assert sorted(r.meta_id for r in pipe.table(BRONZE).collect()) == list("123456")
    assert counts(pipe.table(EDITS)) == {0: 3, 5: 2}


def test_rows_behind_the_watermark_are_counted(spark, log_folder, settings):
    files = [[at(t, i)] for i, t in enumerate(("0:10", "5:00", "0:30", "20:00", "0:40", "20:30"))]
    pipe = run(pipeline(spark, log_folder(*files), settings, max_files=1), BRONZE)
    kept = {r.meta_id for r in pipe.table(BRONZE).collect()}
    assert kept == {"0", "1", "2", "3", "5"}
    totals = metrics.rows_per_table(pipe.progress()).first()
    assert (totals.rows_written, totals.dropped_rows) == (5, 1)


def test_late_count_has_a_horizon_of_its_own(spark, log_folder, settings):
    """Events 15 minutes behind are lost to bronze but not to the late count."""
    files = [[at("0:05", "z")]]
    for i in range(1, 6):
        stamp = f"2024-01-01T00:{i * 5 + 20:02}:00Z"
        files.append([at(f"{i * 5 + 20}:00", f"n{i}"), at(f"{i * 5 + 5}:00", f"late{i}", ingested_at=stamp)])
    files.append([record("end", "2024-01-03T00:00:00Z")])
    pipe = run(pipeline(spark, log_folder(*files), settings, max_files=1), BRONZE, LATE)
    late = pipe.table(LATE).agg(F.sum("late_event_count")).first()[0]
    assert late == 5
    assert pipe.table(BRONZE).filter(F.col("meta_id").startswith("late")).count() < 5
    rows = metrics.rows_per_table(pipe.progress()).filter("query = 'late_arrivals'").first()
    assert rows.late_events == 5


@pytest.fixture
def traffic():
    """Events in order of time with copies nearby; a third belong to one feed."""
    rng = random.Random(11)
    lines = []
    for i in range(600):
        feed = "busy" if i % 3 == 0 else f"w{i % 5}"
        line = at(
            f"{i // 12}:{i % 12 * 5}", f"e{i}", wiki=feed, bot=i % 7 == 0, title=f"t{i % 4}",
            ingested_at=f"2024-01-01T00:{i // 12 + (3 if i % 10 == 0 else 0):02}:59Z",
        )
        lines += [line] * (2 if rng.random() < 0.1 else 1)
        if i % 50 == 0:
            lines.append("not json")
    return lines


@pytest.mark.parametrize("gold_from", ["bronze", "source"])
def test_stream_equals_settled_batch(spark, log_folder, tmp_path, traffic, gold_from):
    path = log_folder(traffic[:200], traffic[200:450], traffic[450:])
    settings = Settings(root=str(tmp_path / "root"), gold_from=gold_from, late_horizon="2 minutes",
                        state_partitions=2, splits=2)
    pipe = pipeline(spark, path, settings, max_files=1)
    pipe.run_available()

    accepted, rejected = gate(LogSource(path=path).read(spark, stream=False))
    events = first_copies(accepted)
    assert compare.same_rows(pipe.table(BRONZE), events, BRONZE.column_names).first().equal
    assert compare.same_rows(pipe.table(REJECTS), rejected).first().equal
    for spec in windows.GOLD_SPECS:
        expected = windows.settled(spec.build(events), events, "2 minutes")
        result = compare.same_rows(pipe.table(spec.table), expected).first()
        assert result.equal and result.left_rows > 0, spec.table.name


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_gives_the_same_bronze(spark, log_folder, tmp_path, traffic, seed):
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(traffic)), 3))
    files = [traffic[a:b] for a, b in zip([0, *cuts], [*cuts, len(traffic)])]
    settings = Settings(root=str(tmp_path / "root"), state_partitions=2, splits=2)
    pipe = run(pipeline(spark, log_folder(*files), settings, max_files=1), BRONZE)
    ids = [r.meta_id for r in pipe.table(BRONZE).select("meta_id").collect()]
    assert sorted(ids) == sorted(f"e{i}" for i in range(600))


def test_restart_continues_and_replay_changes_nothing(spark, log_folder, settings, traffic):
    both = lambda: run(run(pipeline(spark, path, settings), BRONZE), EDITS)
    path = log_folder(traffic[:300])
    both()
    log_folder(traffic[300:])
    again = both()
    before = again.table(BRONZE).count(), again.table(EDITS).count()
    assert before[0] == 600

    for table in (BRONZE, EDITS):
        last = max(p.batchId for p in again.queries[table.name].recentProgress)
        storage.delete(spark, f"{settings.checkpoint(table.name)}/commits/{last}")
    replayed = both()
    assert (replayed.table(BRONZE).count(), replayed.table(EDITS).count()) == before
    assert replayed.table(BRONZE).select("meta_id").distinct().count() == 600


def test_overwritten_batches_survive_a_replay(spark, log_folder, settings, tmp_path):
    path = log_folder(["x", record("a")], ["y", "z"])
    rejected = gate(LogSource(path=path, max_files=1).read(spark))[1]
    out = str(tmp_path / "rejects")
    for _ in range(2):
        overwrite_batches(rejected, out, settings, "rejects", available_now=True).awaitTermination()
        storage.delete(spark, f"{settings.checkpoint('rejects')}/commits/1")
    assert sorted(r.raw_json for r in spark.read.parquet(out).collect()) == ["x", "y", "z"]


def test_metrics_table(spark, log_folder, settings, traffic):
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        pipe = pipeline(spark, log_folder(traffic[:300], traffic[300:]), settings, max_files=1)
        pipe.run_available()
        expected = {t.name: pipe.table(t).count() for t in (BRONZE, *GOLD, REJECTS)}
        wanted = sum(len(q.recentProgress) for q in pipe.queries.values())
        for _ in range(100):
            if len(recorder._rows) >= wanted:
                break
            spark.range(1).count()
    finally:
        spark.streams.removeListener(recorder)
    assert recorder.flush(spark, settings.metrics_path) == wanted
    assert recorder.flush(spark, settings.metrics_path) == 0
    table = metrics.read_metrics(spark, settings.metrics_path)
    written = {r.query: r.rows_written for r in metrics.rows_per_table(table).collect()}
    assert written == expected
    assert metrics.last_duration(table).filter("duration_seconds > 0").count() == 6
    newest = metrics.newest_so_far(table).filter(f"query = '{BRONZE.name}'").orderBy("batch_id").collect()
    times = [r.newest_event_time for r in newest]
    assert times == sorted(times)
    assert metrics.write_rate(table).agg(F.sum("n")).first()[0] == sum(expected.values())
    assert metrics.reject_rate(table).agg(F.sum("n")).first()[0] == expected["rejects"]
    late = pipe.table(LATE).agg(F.sum("late_event_count")).first()[0] or 0
    assert (metrics.late_rate(table).agg(F.sum("n")).first()[0] or 0) == late


def test_gold_reads_whole_commits_of_bronze(spark, log_folder, settings):
    """A backlog of many hours in one bronze commit loses nothing in gold."""
    lines = [record(f"e{i}", f"2024-01-0{1 + i // 240}T{i // 10 % 24:02}:{i % 60:02}:00Z", wiki=f"w{i % 3}")
             for i in range(480)]
    pipe = run(pipeline(spark, log_folder(lines), settings), BRONZE)
    run(pipe, PAGES, BOTS)
    events = pipe.table(BRONZE)
    assert events.count() == 480
    for spec in (windows.PAGES_SPEC, windows.BOTS_SPEC):
        expected = windows.settled(spec.build(events), events, "2 minutes")
        assert compare.same_rows(pipe.table(spec.table), expected).first().equal


def test_tables_of_a_catalog(spark, log_folder, tmp_path, traffic):
    """Another format than Parquet goes by table name; ORC stands in for one."""
    settings = Settings(root=str(tmp_path / "root"), sink_format="orc", state_partitions=2, horizon="10 minutes")
    for namespace in ("bronze", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    try:
        pipe = pipeline(spark, log_folder(traffic), settings)
        pipe.run_available()
        assert spark.table("bronze.recentchange").count() == pipe.table(BRONZE).count() == 600
        assert pipe.table(EDITS).count() == spark.table("gold.edits_per_minute_by_wiki").count() > 0
        assert pipe.table(REJECTS).count() == 12
    finally:
        for table in (BRONZE, REJECTS, *GOLD):
            spark.sql(f"DROP TABLE IF EXISTS {table.full_name}")


def test_standing_pipeline(spark, log_folder, tmp_path, traffic):
    """All six queries at once, on a log that grows while they run."""
    settings = Settings(root=str(tmp_path / "root"), trigger="200 milliseconds", late_horizon="2 minutes",
                        state_partitions=2, splits=1)
    path = log_folder(traffic[:150])
    pipe = pipeline(spark, path, settings)
    pipe.start()
    try:
        for cut in (150, 300, 450):
            progressed = pipe.queries[BRONZE.name].lastProgress
            log_folder(traffic[cut:cut + 150])
            deadline = time.time() + 20
            while time.time() < deadline and pipe.queries[BRONZE.name].lastProgress == progressed:
                time.sleep(0.2)
        log_folder(traffic[600:])
        deadline = time.time() + 20
        while time.time() < deadline and pipe.table(BRONZE).count() < 600:
            time.sleep(0.5)
        assert all(q.isActive for q in pipe.queries.values())
    finally:
        pipe.stop()
    # Windows that had no batch left to close them wait for the next event.
    log_folder([at("55:00", "last")])
    again = pipeline(spark, path, settings)
    again.run_available()
    events = first_copies(gate(LogSource(path=path).read(spark, stream=False))[0])
    assert again.table(BRONZE).count() == 601
    for spec in windows.GOLD_SPECS:
        expected = windows.settled(spec.build(events), events, "2 minutes")
        found = compare.difference(again.table(spec.table), expected).collect()
        assert not found, (spec.table.name, found[:5])


def test_a_failing_query_is_raised(spark, log_folder, settings):
    pipe = pipeline(spark, log_folder([record()]), settings)
    spark.streams.resetTerminated()
    pipe.accepted = pipe.accepted.withColumn("wiki", F.raise_error(F.lit("broken")).cast("string"))
    pipe.start(BRONZE)
    with pytest.raises(Exception, match="broken"):
        pipe.await_any()
    pipe.stop()
    spark.streams.resetTerminated()


def test_feed_names_survive_as_folders(spark, log_folder, settings):
    """Names that look like numbers, dates or paths come back as they were."""
    feeds = ["007", "1e3", "2024-01-01", "a b", "x/y", "a=b", "null", "ä%20", " pad "]
    lines = [record(f"e{i}", wiki=feed) for i, feed in enumerate(feeds)]
    lines.append(record("end", "2024-01-02T00:00:00Z"))
    pipe = run(run(pipeline(spark, log_folder(lines), settings), BRONZE), EDITS)
    assert sorted(r.wiki for r in pipe.table(BRONZE).collect()) == sorted([*feeds, "w"])
    assert sorted(r.wiki for r in pipe.table(EDITS).collect()) == sorted(feeds)


@pytest.mark.parametrize("collapse", [True, False])
def test_a_hot_id_and_a_hot_feed(spark, log_folder, tmp_path, collapse):
    """A third of the records are copies of one event, a third one feed."""
    rng = random.Random(5)
    lines = []
    for i in range(6_000):
        time_text = f"2024-01-01T00:{i // 200:02}:{i % 60:02}Z"
        kind = rng.random()
        if kind < 1 / 3:
            lines.append(record("hot", "2024-01-01T00:00:30Z", wiki="hot", title="hot"))
        else:
            lines.append(record(f"e{i}", time_text, wiki="busy" if kind < 2 / 3 else f"w{i % 9}", title=f"t{i % 3}"))
    path = log_folder(lines)
    settings = Settings(root=str(tmp_path / "root"), collapse_copies=collapse, state_partitions=3, splits=3)
    pipe = pipeline(spark, path, settings)
    pipe.run_available()
    ids = [r.meta_id for r in pipe.table(BRONZE).select("meta_id").collect()]
    expected = {line for line in lines}
    assert len(ids) == len(set(ids)) == len(expected)
    events = first_copies(gate(LogSource(path=path).read(spark, stream=False))[0])
    for spec in windows.GOLD_SPECS[:3]:
        settled = windows.settled(spec.build(events), events, "2 minutes")
        assert compare.same_rows(pipe.table(spec.table), settled).first().equal, spec.table.name


def test_pending_windows_wait_for_the_next_event(spark, log_folder, settings):
    """Stopped before the batch that closes its windows, a stream emits them
    after the restart, once there is an event again."""
    path = log_folder([at("0:10", "a"), at("10:00", "b")])
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(key, "false")
    try:
        run(run(pipeline(spark, path, settings), BRONZE), EDITS)
    finally:
        spark.conf.unset(key)
    emitted = lambda: counts(run(run(pipeline(spark, path, settings), BRONZE), EDITS).table(EDITS))
    assert emitted() == {}
    log_folder([at("10:01", "c")])
    assert emitted() == {0: 1}


def test_bronze_that_keeps_everything(spark, log_folder, settings):
    """A late event and a copy stay in bronze; gold streams count each id once."""
    import dataclasses

    keeps = dataclasses.replace(settings, bronze="all")
    path = log_folder(
        [record("a", "2024-01-01T00:20:00Z"), record("a", "2024-01-01T00:20:00Z")],
        [record("b", "2024-01-01T00:40:00Z")],
        [record("late", "2024-01-01T00:00:10Z"), record("c", "2024-01-01T01:00:00Z")],
    )
    pipe = Pipeline(spark, LogSource(path=path, max_files=1).read(spark), keeps)
    pipe.run_available()
    assert sorted(r.meta_id for r in pipe.table(BRONZE).collect()) == ["a", "a", "b", "c", "late"]
    assert {(r.window_start.minute, r.edit_count) for r in pipe.table(EDITS).collect() if r.window_start.minute == 20} == {(20, 1)}


@pytest.mark.parametrize("name", ["stream_bronze", "stream_top_pages"])
def test_queries_of_streams_know_a_width_on_a_cluster(spark, tmp_path, monkeypatch, name):
    from changefeed import config
    from changefeed.plans import queries

    for module in (config, queries):
        monkeypatch.setattr(module, "is_local", lambda session: False, raising=False)
    found = spark.range(1, 41).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-09 00:00:00' + make_dt_interval(0, id * 8)").alias("ts"),
        F.lit(7).cast("bigint").alias("user_id"),
        F.lit("edit").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit('{"k": 3}').alias("props"),
    )
    found.write.parquet(f"{tmp_path}/events.parquet")
    rows = queries.QUERIES[name](spark, str(tmp_path)).collect()
    # Of the 40 events those numbered 1 to 6 and 8 are refused.
    assert len(rows) == 33


def test_a_width_that_is_given_stays(spark, monkeypatch):
    from changefeed import config
    from changefeed.plans import queries

    monkeypatch.setattr(queries, "is_local", lambda session: False, raising=False)
    monkeypatch.setattr(config, "is_local", lambda session: False)
    settings = queries._settings(spark, "given", state_partitions=3, splits=0)
    assert (settings.width(spark), settings.spread_over(spark)) == (3, 0)
    assert queries._settings(spark, "own").width(spark) == 4
    with pytest.raises(ValueError):
        Settings(root="r").width(spark)


@pytest.mark.parametrize(
    "name",
    "load_then_stream orphan_files rebuild_recovers_late replay_equals_control silent_feeds state_rows stream_batches "
    "stream_bot_vs_human stream_bots_from_bronze stream_bronze stream_edits_from_bronze stream_edits_per_minute stream_late "
    "stream_metrics stream_page_edits_10min stream_pages_from_bronze stream_pipeline_counts stream_rejects stream_sessions".split(),
)
def test_queries_of_streams_equal_their_sql_off_local_sessions(spark, tmp_path, monkeypatch, name):
    duckdb = pytest.importorskip("duckdb")
    from changefeed import config
    from changefeed.plans import oracles, queries

    for module in (config, queries):
        monkeypatch.setattr(module, "is_local", lambda session: False, raising=False)
    found = spark.range(1, 4001).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, cast(id * 7 as int), 7)").alias("ts"),
        (F.col("id") % 120).alias("user_id"),
        F.lit("edit").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit('{"k": 3}').alias("props"),
    )
    found.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    df = queries.all_queries()[name](spark, str(tmp_path))
    columns = sorted(df.columns)
    rows = sorted(repr([r[c] for c in columns]) for r in df.collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    result = db.execute(oracles.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = sorted(repr([r[names.index(c)] for c in columns]) for r in result.fetchall())
    assert rows and rows == wanted
