"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.config import work_dir
from changefeed.functions import storage


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_000


def saved(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage and survives lost executors.

    While it is written, Arrow batches have ``BATCH_ROWS`` rows at most: rows
    are whole texts or sets, and two tasks share an executor's memory.
    """
    spark = df.sparkSession
    path, rows = work_dir(spark, label), spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(min(int(rows), BATCH_ROWS) if int(rows) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH, rows)
    return spark.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Remove the table of a frame that ``saved`` gave, once nothing reads it any more."""
    files = df.inputFiles()
    if files:
        storage.delete(df.sparkSession, files[0].rsplit("/", 1)[0], encoded=True)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Every round hangs each root below its smallest neighbour, follows the
    parents to the top by doubling, and keeps the edges between different
    roots. Self-links and repeated edges do no harm; without edges the result
    is empty.
    """
    links = saved(edges.select("a", "b").where("a != b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = saved(nodes.select("node", F.col("node").alias("root")), "labels")
    while not links.isEmpty():
        up = links.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        parents = saved(up.groupBy("child").agg(F.min("parent").alias("parent")), "parents")
        while True:
            over = parents.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
            jumped = parents.join(over, "parent", "left")
            jumped = saved(jumped.select("child", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")), "parents")
            parents = jumped.select("child", "parent")
            if jumped.where("moved").isEmpty():
                break
        labels = labels.join(parents.withColumnRenamed("child", "root"), "root", "left")
        labels = saved(labels.select("node", F.coalesce("parent", "root").alias("root")), "labels")
        for side in ("a", "b"):
            links = links.join(parents.withColumnRenamed("child", side), side, "left")
            links = links.withColumn(side, F.coalesce("parent", side)).drop("parent")
        links = saved(links.where("a != b").select("a", "b").distinct(), "links")
    return labels
