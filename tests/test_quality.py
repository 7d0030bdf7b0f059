import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from changefeed.operators import compare, quality
from conftest import record, utc

T0 = utc("2024-01-01T00:00:00")


def frame(spark, rows):
    return spark.createDataFrame(rows, "meta_id string, event_time timestamp")


def test_duplicates(spark):
    rows = [("hot", T0)] * 500 + [(f"i{n}", T0) for n in range(1000)] + [("i1", T0)]
    df = frame(spark, rows).repartition(4)
    assert tuple(quality.duplicate_check(df).first()) == (1501, 1001, "DUPLICATES-FOUND")
    assert tuple(quality.duplicate_check(df.dropDuplicates()).first()) == (1001, 1001, "OK-NO-DUPLICATES")
    assert {tuple(r) for r in quality.duplicated_keys(df).collect()} == {("hot", 500), ("i1", 2)}
    assert quality.duplicate_check(df, approximate=True).first().total == 1501


def test_residual_duplicates_lie_beyond_the_horizon(spark):
    later = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("a", T0), ("a", later(120)), ("b", T0), ("b", later(121)), ("c", T0)]
    found = quality.residual_duplicates(frame(spark, rows), "2 minutes").collect()
    assert [(r.meta_id, r.copies) for r in found] == [("b", 2)]


def test_freshness(spark):
    df = frame(spark, [("a", T0), ("b", T0 - dt.timedelta(hours=1))])
    for seconds, fresh in ((119, True), (120, False), (-5, True)):
        now = F.lit(T0 + dt.timedelta(seconds=seconds))
        row = quality.freshness(df, now).first()
        assert (row.age_seconds, row.within_limit) == (max(0, seconds), fresh)


def test_no_events_are_not_fresh(spark):
    row = quality.freshness(frame(spark, [("a", T0)]).filter("false"), F.lit(T0)).first()
    assert (row.newest_event_time, row.age_seconds, row.within_limit) == (None, None, False)


def test_verdict(spark):
    def samples(*counts):
        rows = [(t, T0 + dt.timedelta(minutes=k), n) for t, ns in counts for k, n in enumerate(ns)]
        return spark.createDataFrame(rows, "table_name string, sampled_at timestamp, row_count long")

    events = frame(spark, [("a", T0), ("b", T0)])
    fresh = quality.freshness(events, F.lit(T0 + dt.timedelta(seconds=5)))
    stale = quality.freshness(events, F.lit(T0 + dt.timedelta(hours=5)))
    unique = quality.duplicate_check(events)
    twice = quality.duplicate_check(events.union(events))

    def judge(s, f, d):
        return tuple(quality.pipeline_verdict(s, f, d, "bronze", ["g1", "g2"]).first())

    grew = samples(("bronze", [1, 9, 12]), ("g1", [4, 4, 4]), ("g2", [1, 2, 3]))
    assert judge(grew, fresh, unique) == (True, True, True, True, True)
    assert judge(grew, stale, twice) == (True, True, False, False, False)
    assert judge(samples(("bronze", [5, 9, 9]), ("g1", [1, 1])), fresh, unique) == (False, False, True, True, False)
    assert judge(samples(("bronze", [5])), fresh, unique) == (False, False, True, True, False)


def test_newest_growth_has_a_row_for_each_table(spark):
    rows = [(f"t{t}", T0 + dt.timedelta(minutes=k), k * k) for t in range(6) for k in range(9)]
    df = spark.createDataFrame(rows, "table_name string, sampled_at timestamp, row_count long")
    assert sorted((r.table_name, r.growth) for r in quality.newest_growth(df).collect()) == [(f"t{t}", 15) for t in range(6)]


def test_minimum_volume(spark):
    assert tuple(quality.minimum_volume(spark.range(99), 100).first()) == (99, False)
    assert tuple(quality.minimum_volume(spark.range(500), 100).first()) == (100, True)


def test_counts_and_growth(spark):
    counts = quality.table_counts({"a": spark.range(3), "b": spark.range(0), "c": spark.range(5)})
    assert {tuple(r) for r in counts.collect()} == {("a", 3), ("b", 0), ("c", 5)}
    assert quality.total_rows(counts, ["a", "c"]).first().row_count == 8
    later = T0 + dt.timedelta(minutes=1)
    samples = spark.createDataFrame(
        [("a", T0, 3), ("a", later, 4), ("b", T0, 2), ("b", later, 2)],
        "table_name string, sampled_at timestamp, row_count long",
    )
    grown = {r.table_name: (r.growth, r.grew) for r in quality.growth(samples).collect()}
    assert grown == {"a": (1, True), "b": (0, False)}


def test_drift(spark):
    texts = [record(), record(wiki=7), record(extra=[1]), record(meta={"id": "x", "n": {"a": 1}}), "no", "[]"]
    raw = spark.createDataFrame([(t,) for t in texts], "raw_json string")
    found = quality.schema_drift(spark, raw, F.lit("d")).collect()
    assert {(r.json_key, r.json_type, r.row_count, r.finding) for r in found} == {
        ("wiki", "BIGINT", 1, "retyped"),
        ("extra", "ARRAY", 1, "new"),
        ("meta.n", "OBJECT", 1, "new"),
    }
    types = {(r.json_key, r.json_type): r.row_count for r in quality.key_types(spark, raw, F.lit("d")).collect()}
    assert types[("meta", "OBJECT")] == 4
    assert types[("meta.id", "STRING")] == 4
    assert types[("meta.dt", "STRING")] == 3


def test_difference_counts_copies_and_nulls(spark):
    left = [("a", 1)] * 300 + [(None, 2), ("b", None)]
    right = [("a", 1)] * 298 + [(None, 2), ("c", 3)]
    ddl = "k string, v long"
    lhs, rhs = spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl)
    expected = {row: n for row, n in ((r, Counter(left)[r] - Counter(right)[r]) for r in {*left, *right}) if n}
    assert {(r.k, r.v): r.surplus for r in compare.difference(lhs, rhs).collect()} == expected
    assert tuple(compare.same_rows(lhs, rhs).first()) == (302, 300, 4, False)
    assert compare.same_rows(lhs, lhs.repartition(3)).first().equal
    assert compare.fingerprint(lhs).first() == compare.fingerprint(lhs.repartition(3)).first()
    assert compare.fingerprint(lhs).first() != compare.fingerprint(rhs).first()
