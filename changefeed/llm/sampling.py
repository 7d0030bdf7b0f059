"""Bounded samples for fitting, and checks of what may be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = 1 << 30


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the value as text, modulo; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def bounded(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows, the same ones for the same rows, spread by a hash of ``key``.

    A first filter on the hash keeps about 1.3 n rows, so the final sort gets
    few rows however large the input.
    """
    total = df.count()
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(7)), F.lit(_SCALE))
    if total > n:
        df = df.where(place < int(_SCALE * min(1.0, 1.3 * n / total + 64 / total)))
    return df.orderBy(place, F.col(key)).limit(n)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, n: dict[int, int], id_col: str, text_col: str
) -> list[tuple[str, int]]:
    """Whole texts and labels of at most ``sum(n.values())`` labelled documents.

    The labels are sampled first; the join then carries a bounded number of
    ids to the documents, and only texts of sampled ids come back.
    Documents with several labels count once, with the largest.
    """
    one = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    one = one.groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("_label"))
    parts = [bounded(one.where(F.col("_label") == value), "_id", size) for value, size in n.items()]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    # Bounded by the parameter: sum(n) rows of two numbers.
    ids = docs.sparkSession.createDataFrame([tuple(r) for r in chosen.collect()], chosen.schema)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).dropna(subset=["_id"])
    rows = texts.join(F.broadcast(ids), "_id").select("_id", "_text", "_label")
    rows = bounded_rows(rows, sum(n.values()))
    return [(r["_text"] or "", int(r["_label"])) for r in sorted(rows, key=lambda r: (r["_id"], r["_text"] or ""))]


def bounded_rows(df: DataFrame, n: int) -> list:
    """Rows of a frame that has n by construction, unless ids repeat; then the first n by id."""
    return df.orderBy("_id", F.xxhash64("_text")).limit(n).collect()
