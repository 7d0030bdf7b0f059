import random
import re

from pyspark.sql import functions as F

from conftest import record
from changefeed.operators.dedup import collapse_batches, first_copies


def copies(spark, n=20_000, hot=0.4, seed=1):
    """Ids with copies that differ; one of them holds a large part of all rows."""
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < hot else f"id-{rng.randrange(n // 4)}", i, rng.randrange(10**6), f"r{i}")
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "meta_id string, n long, micros long, raw_json string")
    return rows, df.select(
        "meta_id",
        F.timestamp_micros("micros").alias("ingested_at"),
        F.timestamp_micros("n").alias("event_time"),
        "micros",
        "raw_json",
    )


def test_earliest_copy_survives_whatever_the_partitioning(spark):
    rows, df = copies(spark)
    earliest = {}
    for key, n, micros, raw in rows:
        earliest[key] = min(earliest.get(key, (micros, n, raw)), (micros, n, raw))
    for partitions in (1, 7):
        got = {r.meta_id: r.raw_json for r in first_copies(df.repartition(partitions)).collect()}
        assert got == {key: raw for key, (_, _, raw) in earliest.items()}


def test_copies_are_dropped_before_the_shuffle(spark):
    _, df = copies(spark, 100)
    plan = first_copies(df)._jdf.queryExecution().executedPlan().toString()
    kinds = re.findall(r"WindowGroupLimit.*, (Partial|Final)", plan)
    assert sorted(kinds) == ["Final", "Partial"]


def test_order_of_equal_times_is_settled_by_the_text(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "z")]
    df = spark.createDataFrame(rows, "meta_id string, raw_json string").select(
        "*", *[F.lit(0).cast("timestamp").alias(c) for c in ("ingested_at", "event_time")]
    )
    survivors = {first_copies(df.repartition(n).orderBy(F.rand(n))).first().raw_json for n in (1, 2, 3)}
    assert len(survivors) == 1


def test_collapse_keeps_the_newest_of_differing_copies(spark):
    rows = [("a", 20), ("b", None), ("a", 1230), ("c", 5), ("b", 7), ("a", 40), ("d", None), ("c", 5)]
    df = spark.createDataFrame(rows, "meta_id string, s int").coalesce(1)
    df = df.select("meta_id", F.timestamp_seconds("s").alias("event_time"), "s")
    kept = sorted(((r.meta_id, r.s) for r in collapse_batches(df).collect()), key=str)
    assert kept == [("a", 1230), ("b", 7), ("c", 5), ("d", None)]


def test_a_late_copy_does_not_take_a_timely_one_with_it(spark, log_folder, settings):
    from changefeed.schema import BRONZE
    from changefeed.sources import LogSource
    from changefeed.streaming import Pipeline

    path = log_folder(
        [record("a", "2024-01-01T00:20:00Z")],
        [record("b", "2024-01-01T00:20:01Z")],
        [record("x", "2024-01-01T00:00:10Z"), record("x", "2024-01-01T00:20:30Z")],
    )
    pipe = Pipeline(spark, LogSource(path=path, max_files=1).read(spark), settings)
    for query in pipe.start(BRONZE, available_now=True):
        query.awaitTermination()
    assert {r.meta_id for r in pipe.table(BRONZE).collect()} == {"a", "b", "x"}


def test_collapse_keeps_every_id(spark):
    rows, df = copies(spark, 20_000)
    kept = collapse_batches(df.repartition(2)).collect()
    assert {r.meta_id for r in kept} == {key for key, *_ in rows}
    # Two tasks, 10,000 rows to an Arrow batch: a handful of hot rows is left.
    assert sum(r.meta_id == "hot" for r in kept) <= 8
    assert {r.raw_json for r in kept} <= {raw for *_, raw in rows}
