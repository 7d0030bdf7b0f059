"""Session settings and the parameters that a deployment may change."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SESSION_CONF = {
    # Event times are compared with and printed in UTC, whatever the host says.
    "spark.sql.session.timeZone": "UTC",
    # Deduplication and window state may outgrow the heap; RocksDB keeps it on
    # disk, and its changelog keeps each commit proportional to the change.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


@dataclass(frozen=True)
class Settings:
    """Where a pipeline lives and how it runs.

    ``root`` must be storage that every executor sees. ``horizon`` bounds the
    deduplication state, ``watermark`` the windows; they may differ because the
    gold streams read bronze and so carry a watermark of their own.
    """

    root: str
    watermark: str = "2 minutes"
    horizon: str = "2 minutes"
    late_after: str = "2 minutes"
    # A longer horizon for the late count: an event later than the horizon of
    # its own query can never be counted by it. Its windows close that late.
    late_horizon: str = "1 hour"
    trigger: str = "60 seconds"
    # Shuffle width of the stateful operators. The checkpoint keeps the one it
    # was started with, and streams are not re-planned at run time, so it has
    # to suit the cluster and must be given there; a local session may leave it
    # out and gets one partition per core.
    state_partitions: int | None = None
    # Tasks that may share the rows of one (day, feed) pair in one micro-batch;
    # None: a quarter of the state partitions. 0 turns the spreading off.
    splits: int | None = None
    # Drop copies that sit in the same Arrow batch before the shuffle by id.
    collapse_copies: bool = True
    # "once": bronze holds each id once; an event behind the horizon is dropped.
    # "all": bronze holds every accepted record, however late, and copies too;
    # gold streams deduplicate what they read, and batch readers take
    # ``first_copies``, so a rebuild with a longer delay gets late events back.
    bronze: str = "once"
    # "bronze": parse and deduplicate once, gold reads bronze.
    # "source": every gold query starts at the log.
    gold_from: str = "bronze"
    # Parquet folders below ``root``, or tables of a catalog in another format.
    sink_format: str = "parquet"
    catalog: str | None = None
    sink_options: dict[str, str] = field(default_factory=dict)

    @property
    def in_catalog(self) -> bool:
        return self.sink_format != "parquet"

    def table_name(self, full_name: str) -> str:
        return f"{self.catalog}.{full_name}" if self.catalog else full_name

    def table_path(self, namespace: str, name: str) -> str:
        return f"{self.root}/tables/{namespace}/{name}"

    def copies_path(self, namespace: str, name: str) -> str:
        return f"{self.root}/copies/{namespace}/{name}"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"

    def width(self, spark: SparkSession) -> int:
        """Shuffle partitions of the stateful operators."""
        if self.state_partitions:
            return self.state_partitions
        if not is_local(spark):
            raise ValueError("set state_partitions: the checkpoint keeps it for good")
        return spark.sparkContext.defaultParallelism

    def spread_over(self, spark: SparkSession) -> int:
        return max(2, self.width(spark) // 4) if self.splits is None else self.splits

    @property
    def metrics_path(self) -> str:
        return f"{self.root}/metrics/progress"


def build_session(app_name: str = "changefeed", **conf: str) -> SparkSession:
    """A session with the settings above; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made by someone else."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and tasks are one process (``local-cluster`` is not local)."""
    return spark.sparkContext.master.split("[")[0] == "local"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder on the storage that ``spark.checkpoint.dir`` names.

    Only a session whose executor is the driver itself may go without that
    setting; it then gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="changefeed-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
