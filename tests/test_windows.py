import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changefeed.operators import windows
from conftest import utc

START = utc("2024-01-01T00:00:00")


@pytest.fixture(scope="module")
def sample(spark):
    """A third of the events belong to one feed and one page."""
    rng = random.Random(7)
    rows = []
    for _ in range(6_000):
        busy = rng.random() < 1 / 3
        time = START + dt.timedelta(seconds=rng.randrange(7200), microseconds=rng.randrange(10**6))
        rows.append(
            (
                time,
                time + dt.timedelta(seconds=rng.randrange(240)),
                "busy" if busy else f"w{rng.randrange(5)}",
                "page" if busy else f"p{rng.randrange(40)}",
                rng.random() < 0.2,
                rng.choice(["edit", "log"]),
            )
        )
    ddl = "event_time timestamp, ingested_at timestamp, wiki string, title string, bot boolean, type string"
    return rows, spark.createDataFrame(rows, ddl).repartition(5)


def floor(time, minutes):
    return START + (time - START) // dt.timedelta(minutes=minutes) * dt.timedelta(minutes=minutes)


def starts(df, *columns):
    """Rows keyed by minutes since the start, clear of driver time zones."""
    minute = (F.unix_micros("window_start") / 60e6 - START.timestamp() / 60).cast("int")
    return df.select(minute.alias("minute"), *columns).collect()


def minute_of(time):
    return int((time - START).total_seconds() // 60)


@pytest.mark.parametrize("spec", windows.GOLD_SPECS, ids=lambda s: s.table.name)
def test_gold_counts(sample, spec):
    rows, df = sample
    length = int(spec.length.split()[0])
    expected = Counter()
    for time, arrived, wiki, title, bot, _ in rows:
        if spec.late_only and arrived - time <= dt.timedelta(minutes=2):
            continue
        keys = {"wiki": wiki, "title": title, "bot": bot}
        expected[(minute_of(floor(time, length)), *[keys[k] for k in spec.keys])] += 1
    got = spec.build(df)
    assert got.columns == spec.table.column_names
    counted = {tuple(r)[:-1]: tuple(r)[-1] for r in starts(got, *spec.keys, spec.count_name)}
    assert counted == dict(expected)
    assert all(r.s == length * 60 for r in got.select(
        (F.unix_seconds("window_end") - F.unix_seconds("window_start")).alias("s")).distinct().collect())


def test_edits_are_the_sum_of_bots_and_others(sample):
    _, df = sample
    rolled = windows.edits_from_bots(windows.BOTS_SPEC.build(df))
    direct = windows.EDITS_SPEC.build(df)
    assert sorted(map(tuple, rolled.collect())) == sorted(map(tuple, direct.collect()))


def test_lateness_is_strict(spark):
    rows = [(START, START + dt.timedelta(seconds=s)) for s in (120, 121)]
    df = spark.createDataFrame(rows, "event_time timestamp, ingested_at timestamp")
    assert df.filter(windows.is_late("2 minutes")).count() == 1


def test_top_pages_and_ties(sample):
    rows, df = sample
    counts = Counter((minute_of(floor(r[0], 10)), r[2], r[3]) for r in rows)
    groups = {}
    for (minute, wiki, title), n in counts.items():
        groups.setdefault((minute, wiki), []).append((-n, title))
    expected = {
        (*group, rank, title, -n)
        for group, pages in groups.items()
        for rank, (n, title) in enumerate(sorted(pages)[:3], 1)
    }
    top = windows.top_pages(windows.PAGES_SPEC.build(df), 3)
    assert {tuple(r) for r in starts(top, "wiki", "rank", "title", "edit_count")} == expected
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_shares(sample):
    rows, df = sample
    total = Counter((minute_of(r[0]), r[2]) for r in rows)
    bots = Counter((minute_of(r[0]), r[2]) for r in rows if r[4])
    share = windows.bot_share(windows.BOTS_SPEC.build(df))
    assert {(r.minute, r.wiki): r.bot_share for r in starts(share, "wiki", "bot_share")} == {
        key: bots[key] / n for key, n in total.items()
    }
    hour = windows.predicate_share(df, F.col("type") == "log", "1 hour", ["wiki"])
    logs = Counter((minute_of(floor(r[0], 60)), r[2]) for r in rows if r[5] == "log")
    assert {(r.minute, r.wiki): r.match_count for r in starts(hour, "wiki", "match_count")} == dict(logs)


def test_sliding_windows(sample):
    rows, df = sample
    sliding = windows.windowed_count(df, "10 minutes", ["wiki"], "n", slide="5 minutes")
    assert sliding.agg(F.sum("n")).first()[0] == 2 * len(rows)


def test_rate(sample):
    rows, df = sample
    per_minute = Counter(minute_of(r[0]) for r in rows)
    got = starts(windows.rate(df, "event_time", 60), "per_second")
    assert {r.minute: r.per_second for r in got} == {m: n / 60 for m, n in per_minute.items()}


def test_settled_windows_end_at_the_watermark(spark):
    rows = [(START + dt.timedelta(seconds=s), "w") for s in (10, 70, 130, 240)]
    df = spark.createDataFrame(rows, "event_time timestamp, wiki string")
    kept = windows.settled(windows.windowed_count(df, "1 minute", ["wiki"], "n"), df, "2 minutes")
    # Newest 4:00, so the watermark is 2:00 and the window that ends there is closed.
    assert sorted(r.minute for r in starts(kept)) == [0, 1]
