"""Copies of tables for use elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def export_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite ``path`` with the table.

    Without a number of files Spark sizes them, which gives a small table one
    file and spares a large one a single task.
    """
    sized = df.hint("rebalance") if files is None else df.repartition(files)
    sized.write.mode("overwrite").parquet(path)


def bronze_sample(
    bronze: DataFrame, n: int = 50_000, repeatable: bool = True, key: str = "meta_id"
) -> DataFrame:
    """``n`` rows: those with the lowest hash of id, or any.

    A plain top-n sends up to ``n`` rows of *every* task to one last task. So
    a share of the ids a little above ``n`` / rows, the lowest by hash, is
    picked first; where copies of few ids make that too few rows, four times
    as much is tried, up to everything.
    """
    if not repeatable:
        return bronze.limit(n)
    digest = F.md5(F.col(key))
    total = bronze.count()
    share = (1.3 * n + 1_000) / max(1, total)
    while share < 1:
        # Hashes are spread evenly and hexadecimal text sorts as the numbers do.
        lowest = bronze.filter(digest < f"{int(share * 16**12):012x}")
        if lowest.count() >= n:
            return lowest.orderBy(digest, key).limit(n)
        share *= 4
    return bronze.orderBy(digest, key).limit(n)


def export_json_lines(log: DataFrame, path: str, n: int = 2_000) -> None:
    """``n`` raw records, one per line.

    The limit is kept by each task and then by one, so ``n`` records a task
    are read at most and none pass through the driver.
    """
    log.select("raw_json").limit(n).coalesce(1).write.mode("overwrite").text(path)
