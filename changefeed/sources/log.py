"""The raw event log: one JSON text per record, from files or from Kafka."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class LogSource:
    """A log to read as a stream or as a batch.

    ``format`` is ``text`` (one record per line), ``parquet`` (a ``raw_json`` or
    ``value`` column) or ``kafka``. Kafka needs its connector on the class path
    and was not run here.
    """

    format: str = "text"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    schema: str = "value string"
    tolerate_loss: bool = True
    # Caps for one micro-batch. None reads all that is there.
    max_files: int | None = None
    max_bytes: str | None = None
    max_offsets: int | None = None

    def _options(self, stream: bool) -> dict[str, str]:
        chosen = {}
        if self.format == "kafka":
            chosen["startingOffsets"] = "earliest"
            chosen["failOnDataLoss"] = str(not self.tolerate_loss).lower()
            if stream and self.max_offsets:
                chosen["maxOffsetsPerTrigger"] = str(self.max_offsets)
        else:
            chosen["ignoreMissingFiles"] = str(self.tolerate_loss).lower()
            if stream and self.max_files:
                chosen["maxFilesPerTrigger"] = str(self.max_files)
            if stream and self.max_bytes:
                chosen["maxBytesPerTrigger"] = self.max_bytes
        return {**chosen, **self.options}

    def load(self, spark: SparkSession, stream: bool = True, files: list[str] | None = None) -> DataFrame:
        """Columns of the source itself, with the record in bytes or text; ``files``: of these alone (batch)."""
        reader = (spark.readStream if stream else spark.read).format(self.format)
        reader = reader.options(**self._options(stream))
        if self.format == "kafka":
            return reader.load()
        return reader.schema(self.schema).load(self.path if files is None else files)

    def read(self, spark: SparkSession, stream: bool = True, files: list[str] | None = None, unread: bool = False) -> DataFrame:
        """``raw_json`` and ``arrived_at``, the time the log got the record.

        The arrival time is a property of the log, so a replayed batch sees the
        same one; it stands in for a record without a usable ``ingested_at``.
        ``unread`` lists the files of a file log and opens none.
        """
        df = self.load(spark, stream, files)
        if unread:
            # A filter on the listing; a constant would remove the stateful operators from the plan.
            df = df.filter(F.col("_metadata.file_path") == "")
        if self.format == "kafka":
            text, arrived = F.col("value").cast("string"), F.col("timestamp")
        else:
            text = F.col("raw_json" if "raw_json" in df.columns else "value").cast("string")
            arrived = F.col("_metadata.file_modification_time")
            if "arrived_at" in df.columns:
                arrived = F.col("arrived_at")
        return df.select(text.alias("raw_json"), arrived.alias("arrived_at"))


def widened(df: DataFrame, width: int | None) -> DataFrame:
    """Spread an input of few splits over ``width`` tasks before it is parsed.

    A file is split at its row groups, so a small table is one task, while
    parsing is the costly step. None leaves the input as it is, without a
    shuffle: the choice for all large ones.
    """
    return df if width is None else df.repartition(width)


def sample(log: DataFrame, n: int) -> DataFrame:
    """Any ``n`` records of a log."""
    return log.select("raw_json").limit(n)


def rows_per_partition(loaded: DataFrame) -> DataFrame:
    """Record count of each log partition, or of each file of a file log."""
    by = F.col("partition") if "partition" in loaded.columns else F.col("_metadata.file_path")
    return loaded.groupBy(by.alias("log_partition")).agg(F.count(F.lit(1)).alias("row_count"))


def feed_key(raw_json: str = "raw_json") -> Column:
    """The feed name inside a record, ``unknown`` where there is none."""
    return F.coalesce(F.get_json_object(raw_json, "$.wiki"), F.lit("unknown"))


def keyed(log: DataFrame, partitions: int) -> DataFrame:
    """Adds the record key and the log partition that the key belongs to."""
    return log.withColumn("feed", feed_key()).withColumn(
        "log_partition", F.pmod(F.xxhash64("feed"), F.lit(partitions)).cast("int")
    )


def land(log: DataFrame, path: str, files: int, splits: int = 8) -> None:
    """Write records as text files, the records of one feed close together.

    ``splits`` tasks share a feed, so that a busy one does not end up in a
    single file.
    """
    salt = F.pmod(F.xxhash64("raw_json"), F.lit(splits))
    (
        log.select("raw_json", feed_key().alias("feed"))
        .repartition(files, "feed", salt)
        .select("raw_json")
        .write.mode("append")
        .text(path)
    )


def land_by_feed(log: DataFrame, path: str, files: int, open_files: int = 100) -> None:
    """Write records as a Parquet file in a folder for each feed.

    Feeds are dealt over ``files`` tasks. A task keeps a file open for each of
    its feeds, with a small buffer, instead of sorting its records by feed, so
    its memory does not grow with a feed. Beyond ``open_files`` feeds of one
    task the rest are sorted.
    """
    spark, setting = log.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, open_files)
    try:
        (
            log.select("raw_json", feed_key().alias("feed"))
            .repartition(files, "feed")
            .write.partitionBy("feed")
            .option("parquet.block.size", 8 << 20)
            .parquet(path)
        )
    finally:
        spark.conf.set(setting, usual)
