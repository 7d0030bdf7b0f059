import math
import random

import pytest
from pyspark.sql import functions as F

from changefeed.operators.percentiles import (
    POINTS,
    approximate_percentiles,
    exact_percentiles,
)


def nearest_rank(values, point):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(point * len(ordered))) - 1]


@pytest.fixture(scope="module")
def measures(spark):
    """One group with many equal values, one with all different, one of one row."""
    rng = random.Random(3)
    rows = [("hot", rng.choice([0, 0, 0, 5, 10**9])) for _ in range(9_000)]
    rows += [("fine", rng.randrange(-3 * 10**6, 4 * 10**6)) for _ in range(5_000)]
    rows += [("single", 42)]
    return rows, spark.createDataFrame(rows, "wiki string, v long").repartition(6)


@pytest.mark.parametrize("width", [1_000_000, 1_000, 10**12])
def test_exact(measures, width):
    rows, df = measures
    got = exact_percentiles(df, F.col("v"), "wiki", width=width).collect()
    groups = {}
    for wiki, value in rows:
        groups.setdefault(wiki, []).append(value)
    assert {(r.wiki, r.point): r.value for r in got} == {
        (wiki, point): nearest_rank(values, point) for wiki, values in groups.items() for point in POINTS
    }
    assert {r.wiki: r.event_count for r in got} == {k: len(v) for k, v in groups.items()}


def test_approximate_is_close(measures):
    rows, df = measures
    fine = [v for wiki, v in rows if wiki == "fine"]
    got = approximate_percentiles(df, F.col("v"), "wiki").filter("wiki = 'fine'").collect()
    for row in got:
        assert abs(row.value - nearest_rank(fine, row.point)) < 20_000
