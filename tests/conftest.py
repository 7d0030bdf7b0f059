from __future__ import annotations

import datetime as dt
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from changefeed.config import SESSION_CONF, Settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("changefeed-tests")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(tmp_path):
    return Settings(root=str(tmp_path / "root"), state_partitions=2, splits=2)


def utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def record(event_id="a", time="2024-01-01T00:00:10Z", **changes) -> str:
    """A good change event; a value of ``...`` leaves the key out."""
    event = {
        "meta": {"id": event_id, "dt": time},
        "wiki": "w",
        "type": "edit",
        "title": "t",
        "user": "u",
        "bot": False,
        "server_name": "s",
        "ingested_at": time,
    }
    event.update(changes)
    return json.dumps({k: v for k, v in event.items() if v is not ...})


@pytest.fixture
def log_folder(tmp_path):
    """Writes a file per list of records, in the order a stream reads them."""
    folder = tmp_path / "log"
    folder.mkdir()
    count = [0]

    def write(*files: list[str]) -> str:
        for lines in files:
            path = folder / f"f{count[0]:03}.json"
            path.write_text("".join(f"{line}\n" for line in lines))
            moment = 1_700_000_000 + count[0] * 60
            os.utime(path, (moment, moment))
            count[0] += 1
        return str(folder)

    return write
