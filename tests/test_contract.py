"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from changefeed.plans.queries import all_queries

DIRECTORY = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{DIRECTORY}/events.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["window_start", "window_end", "wiki", "edit_count"]


@pytest.mark.parametrize("name", all_queries())  # other packages test their own
def test_query(spark, db, name):
    df = contract.queries()[name](spark, DIRECTORY)
    rows = df.collect()
    assert rows
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        result = db.execute(sql)
        columns = [d[0] for d in result.description]
        assert sorted(df.columns) == sorted(columns)
        assert canonical(df.columns, rows) == canonical(columns, result.fetchall())
