import glob
import shutil

import pytest
from pyspark.sql import functions as F

from changefeed.operators.gate import gate
from changefeed.sources import (
    LogSource,
    change_log,
    intake,
    keyed,
    land,
    read_captured,
    read_events,
    rows_per_partition,
    sample,
    stream_events,
)
from changefeed.sources.log import widened
from conftest import record

BLOCKS = """: a comment

id: 1
data: {"a": 1}

event: message
id:2
data: {"b":
data:  2}

id: 3
data: [1, 2]

data: {"no": "id"}

id: 4

id: 5
id: 6
data: {}

id: 7
data: broken
"""


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_captured_blocks(spark, tmp_path, line_end):
    (tmp_path / "capture.txt").write_bytes(BLOCKS.replace("\n", line_end).encode())
    blocks = read_captured(spark, str(tmp_path), line_end=line_end)
    assert {r.event_id: r.raw_json for r in blocks.collect()} == {
        "1": '{"a": 1}',
        "2": '{"b":\n2}',
        "3": "[1, 2]",
        "6": "{}",
        "7": "broken",
    }
    objects, refused = intake(blocks)
    assert {r.event_id for r in refused.collect()} == {"3", "7"}
    stamped = objects.select(
        "event_id",
        F.try_parse_json("raw_json").isNotNull().alias("valid"),
        F.get_json_object("raw_json", "$.ingested_at").alias("at"),
    ).collect()
    assert {r.event_id for r in stamped} == {"1", "2", "6"}
    assert all(r.valid and r.at.startswith("20") for r in stamped)


def test_captured_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "capture.txt").write_text(BLOCKS)
    query = (
        read_captured(spark, str(source), stream=True)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_stamp_replaces_an_older_one(spark):
    df = spark.createDataFrame([("1", record(ingested_at="1999-01-01T00:00:00Z"))], "event_id string, raw_json string")
    row = gate(intake(df)[0])[0].select(F.year("ingested_at").alias("y")).first()
    assert row.y > 2000


def test_text_log(spark, log_folder):
    path = log_folder([record("a"), "not json"], [record("b")])
    source = LogSource(path=path)
    log = source.read(spark, stream=False)
    assert log.columns == ["raw_json", "arrived_at"]
    assert {r.raw_json for r in log.collect()} == {record("a"), "not json", record("b")}
    assert sample(log, 2).count() == 2
    counts = rows_per_partition(source.load(spark, stream=False)).collect()
    assert sorted(r.row_count for r in counts) == [1, 2]
    # The arrival time is the file's own, the same on every read.
    at = log.filter("raw_json = 'not json'").select(F.unix_seconds("arrived_at").alias("s"))
    assert at.first().s == 1_700_000_000


def test_binary_and_parquet_logs(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b'{"a":1}'),)], "value binary")
    df.write.parquet(str(tmp_path / "bytes"))
    source = LogSource("parquet", str(tmp_path / "bytes"), schema="value binary")
    assert source.read(spark, stream=False).first().raw_json == '{"a":1}'


def test_options():
    files = LogSource(path="x", max_files=3, max_bytes="1g", options={"lineSep": "\n"})
    assert files._options(True) == {
        "ignoreMissingFiles": "true", "maxFilesPerTrigger": "3", "maxBytesPerTrigger": "1g", "lineSep": "\n",
    }
    kafka = LogSource("kafka", max_offsets=5000, options={"subscribe": "t"})
    assert kafka._options(True) == {
        "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5000", "subscribe": "t",
    }
    assert "maxOffsetsPerTrigger" not in kafka._options(False)


def test_landing_keeps_all_and_splits_the_busy_feed(spark, tmp_path):
    texts = [record(f"e{i}", wiki="busy" if i % 3 else f"w{i % 7}") for i in range(2_000)]
    log = spark.createDataFrame([(t,) for t in texts], "raw_json string")
    land(log, str(tmp_path / "log"), files=8, splits=4)
    back = LogSource(path=str(tmp_path / "log")).read(spark, stream=False)
    assert sorted(r.raw_json for r in back.collect()) == sorted(texts)
    busy = [p for p in glob.glob(f"{tmp_path}/log/part-*") if '"busy"' in open(p).read()]
    assert len(busy) > 1


def test_keys(spark):
    texts = [record(wiki="a"), record("b", wiki="a"), record(wiki=...), "not json"]
    rows = keyed(spark.createDataFrame([(t,) for t in texts], "raw_json string"), 6).collect()
    assert sorted(r.feed for r in rows) == ["a", "a", "unknown", "unknown"]
    assert len({(r.feed, r.log_partition) for r in rows}) == 2
    assert all(0 <= r.log_partition < 6 for r in rows)


def test_inputs_are_spread_on_demand_alone(spark):
    df = spark.range(0, 100, 1, 1)
    assert widened(df, None) is df
    assert widened(df, 5).rdd.getNumPartitions() == 5


@pytest.mark.parametrize("files", [1, 3])
def test_events_may_be_a_file_or_a_folder(spark, tmp_path, files):
    rows = spark.range(50).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01' ts", "id user_id", "'c' event_type", "1d value", "'{}' props"
    )
    rows.repartition(files).write.parquet(str(tmp_path / "w"))
    (tmp_path / "t").mkdir()
    if files == 1:
        shutil.copy(glob.glob(f"{tmp_path}/w/part-*")[0], tmp_path / "t" / "events.parquet")
    else:
        shutil.copytree(tmp_path / "w", tmp_path / "t" / "events.parquet")
    assert read_events(spark, str(tmp_path / "t")).count() == 50
    query = (
        stream_events(spark, str(tmp_path / "t"))
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_change_log(spark):
    events = spark.range(0, 303).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-01 00:00:00.000001").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 13).alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit('{"k": 5}').alias("props"),
    )
    log = change_log(events)
    assert log.count() == 303 + 7
    accepted, rejected = gate(log)
    assert rejected.count() == 3 * 8 + 1  # event 0 comes twice
    assert accepted.filter("meta_id = 'evt-50'").count() == 2
    row = accepted.filter("meta_id = 'evt-10'").first()
    assert (row.wiki, row.title, row.bot, row.user) == ("wiki4", "page-5", True, "u10")


def test_a_file_for_each_feed_though_tasks_have_many(spark, tmp_path):
    from changefeed.sources.log import land_by_feed, rows_per_partition

    setting = "spark.sql.maxConcurrentOutputFileWriters"
    usual = spark.conf.get(setting)
    log = spark.range(700).selectExpr("""concat('{"wiki":"w', id % 7, '/ é"}') AS raw_json""")
    land_by_feed(log.unionByName(spark.sql("SELECT 'no' AS raw_json")), f"{tmp_path}/feeds", files=2, open_files=2)
    assert spark.conf.get(setting) == usual
    source = LogSource(format="parquet", path=f"{tmp_path}/feeds", schema="raw_json string")
    assert sorted(r.row_count for r in rows_per_partition(source.load(spark, stream=False)).collect()) == [1] + [100] * 7


def test_rows_per_file_deals_feeds_to_tasks(spark, tmp_path):
    from changefeed.plans import queries

    found = spark.range(600).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-09 00:00:00' AS ts", "id AS user_id", "'edit' AS event_type", "1D AS value", "'{\"k\": 3}' AS props"
    )
    found.write.parquet(f"{tmp_path}/events.parquet")
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{base}/log-files-*"))
    rows = {r.feed: r.row_count for r in queries.QUERIES["rows_per_file"](spark, str(tmp_path)).collect()}
    assert sum(rows.values()) == 612 and len(rows) == 8
    (path,) = set(glob.glob(f"{base}/log-files-*")) - before
    files = glob.glob(f"{path}/feed=*/part-*.parquet")
    # The whole log went through one task and its sort.
    assert len(files) == 8 and len({f.rsplit("/part-", 1)[1][:5] for f in files}) > 1
