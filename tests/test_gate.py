import pytest
from pyspark.sql import functions as F

from changefeed.operators.gate import Rule, decode, default_rules, envelope, gate, judged
from conftest import record

META, TIME, FEED, TYPE = (
    f"missing_or_invalid_{name}" for name in ("meta.id", "meta.dt", "wiki", "type")
)
ALL = "; ".join((META, TIME, FEED, TYPE))

CASES = [
    ("not json", f"invalid_json; {ALL}"),
    ("", f"invalid_json; {ALL}"),
    (None, f"invalid_json; {ALL}"),
    ('{"meta": {"id": "x", "dt": "2024', f"invalid_json; {ALL}"),
    ("[]", ALL),
    ("[" + record() + "]", ALL),
    ('"text"', ALL),
    ("{}", ALL),
    (record(7), META),
    (record("  "), META),
    (record(None), META),
    (record(meta="x"), f"{META}; {TIME}"),
    (record(time="bad"), TIME),
    (record(wiki=...), FEED),
    (record(wiki="  "), FEED),
    (record(wiki=["w"]), FEED),
    (record(type=5), TYPE),
    (record(type=True), TYPE),
    (record(), ""),
    (record(bot=...), ""),
    (record(extra={"wiki": 1}), ""),
    (record(meta={"origin": {"n": 1}, "id": "x", "dt": "2024-01-01T00:00:10Z"}), ""),
]


def raws(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_json string")


@pytest.mark.parametrize("size", [1, 3])
def test_reasons(spark, size):
    rows = judged(raws(spark, [text for text, _ in CASES] * size)).select("raw_json", "reason").collect()
    expected = dict(CASES)
    assert len(rows) == len(CASES) * size
    for row in rows:
        assert row.reason == expected[row.raw_json], row.raw_json


def test_outcomes_part_the_input(spark):
    accepted, rejected = gate(raws(spark, [text for text, _ in CASES]))
    good = [text for text, reason in CASES if not reason]
    assert sorted(r.raw_json for r in accepted.collect()) == sorted(good)
    assert rejected.count() == len(CASES) - len(good)
    assert rejected.columns == ["raw_json", "reason", "ingested_at"]


def test_values(spark):
    odd = record(title=5, user={"a": 1}, bot="true", server_name=None, ingested_at="2024-01-01T00:01:00+01:00")
    row = gate(raws(spark, [odd]))[0].select(
        "title", "user", "bot", "server_name", F.col("ingested_at").cast("string").alias("at")
    ).first()
    assert (row.title, row.user, row.bot, row.server_name) == ("5", '{"a":1}', False, None)
    assert row.at == "2023-12-31 23:01:00"


def test_repeated_keys_last_one_wins(spark):
    text = record()[:-1] + ', "wiki": "second"}'
    assert gate(raws(spark, [text]))[0].first().wiki == "second"


def test_arrival_time_stands_in_for_a_missing_stamp(spark):
    df = raws(spark, [record(ingested_at=...), record("b", ingested_at="bad"), "not json"]).withColumn(
        "arrived_at", F.lit("2024-02-03 04:05:06").cast("timestamp")
    )
    times = decode(df).select(F.col("ingested_at").cast("string").alias("at")).distinct().collect()
    assert [r.at for r in times] == ["2024-02-03 04:05:06"]


def test_matched_strings_follow_the_text(spark):
    nested = record(meta={"origin": {"n": 1}, "id": "x", "dt": "2024-01-01T00:00:10Z"})
    elsewhere = record(wiki=7, extra={"wiki": "w"})
    reasons = {
        r.raw_json: r.reason
        for r in judged(raws(spark, [nested, elsewhere, record(), record(7)]), strings="matched").collect()
    }
    assert reasons == {nested: META, elsewhere: "", record(): "", record(7): META}


def test_own_rules(spark):
    rules = [*default_rules(), Rule("no_user", F.col("user").isNull())]
    _, rejected = gate(raws(spark, [record(user=None), record()]), rules)
    assert [r.reason for r in rejected.collect()] == ["no_user"]


def test_envelope(spark):
    df = raws(spark, ["not json"]).withColumn("arrived_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    value = envelope(gate(df)[1]).first().value
    assert value == (
        f'{{"reason":"invalid_json; {ALL}","raw_json":"not json","ingested_at":"2024-01-01T00:00:00.000Z"}}'
    )


@pytest.mark.parametrize("outcome", [0, 1])
def test_each_record_is_parsed_once(spark, outcome):
    plan = gate(raws(spark, [record()]))[outcome]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
