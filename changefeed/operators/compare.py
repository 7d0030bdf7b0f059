"""Do two tables hold the same rows?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def difference(left: DataFrame, right: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows whose number of copies differs, with ``surplus`` on the left side.

    Both sides are counted in one aggregation, so nulls
    compare as equal, equal rows collapse before the shuffle, and no key can
    make a join explode.
    """
    return _signed_counts(left, right, columns or left.columns).select(
        *(columns or left.columns), (F.col("left_n") - F.col("right_n")).alias("surplus")
    ).filter("surplus <> 0")


def same_rows(left: DataFrame, right: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the size of both sides and the number of rows that differ."""
    counts = _signed_counts(left, right, columns or left.columns)
    return counts.agg(
        F.coalesce(F.sum("left_n"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("right_n"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.abs(F.col("left_n") - F.col("right_n"))), F.lit(0)).alias("different_rows"),
    ).withColumn("equal", F.col("different_rows") == 0)


def _signed_counts(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    sides = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return sides.groupBy(*columns).agg(F.sum("_l").alias("left_n"), F.sum("_r").alias("right_n"))


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row that two equal tables share: a count and two sums of row hashes.

    No shuffle of rows, so it suits a check of a copy of a large table; it can
    say that two tables differ, not where.
    """
    row_hash = F.xxhash64(*(columns or df.columns))
    return df.select(row_hash.alias("h")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bit_xor("h").alias("hash_xor"),
        F.sum(F.col("h").cast("decimal(20,0)")).alias("hash_sum"),
    )


def digests(df: DataFrame, day: str, key: str, columns: list[str] | None = None, buckets: int = 256) -> DataFrame:
    """What the rows of each day and bucket of keys hold: a count, and the exclusive
    or and the sum of row hashes. To be kept next to a table when its days are
    written, so that a later comparison need not read them."""
    row_hash = F.xxhash64(*(columns or df.columns))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    return df.select(day, bucket.alias("bucket"), row_hash.alias("h")).groupBy(day, "bucket").agg(*_digest_columns())


def _digest_columns(sign: str = "1") -> list:
    return [
        F.expr(f"sum({sign})").alias("row_count"),
        F.bit_xor("h").alias("hash_xor"),
        F.expr(f"sum(cast(h AS decimal(20,0)) * {sign})").alias("hash_sum"),
    ]


def _differing(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose digests differ; a group that one side lacks has nothing there."""
    columns = [*by, "row_count", "hash_xor", "hash_sum"]
    sides = left.select(*columns, F.lit(1).alias("_sign")).unionByName(right.select(*columns, F.lit(-1).alias("_sign")))
    counts, sums = F.sum(F.expr("row_count * _sign")), F.sum(F.expr("hash_sum * _sign"))
    both = sides.groupBy(*by).agg(counts.alias("c"), F.bit_xor("hash_xor").alias("x"), sums.alias("s"))
    return both.filter("c <> 0 OR x <> 0 OR s <> 0").select(*by)


def difference_levels(
    left: DataFrame,
    right: DataFrame,
    left_digests: DataFrame,
    right_digests: DataFrame,
    day: str,
    key: str,
    columns: list[str] | None = None,
    buckets: int = 256,
) -> DataFrame:
    """The rows of :func:`difference`, read from the days and buckets alone whose
    kept digests differ.

    First the days, then the buckets of keys in them: two aggregations over
    kept digests. Then one pass over the days that differ gives a digest per
    key, which shuffles keys and hashes; whole rows are compared for keys that
    differ. ``columns`` and ``buckets`` must be those of the digests, and the
    table's day folders must be a column ``day``: days go into the plan as
    values, one for each day that differs.
    """
    columns = columns or left.columns
    parts = _differing(left_digests, right_digests, [day, "bucket"])
    days = [r[0] for r in parts.select(day).distinct().collect()]
    wanted = F.col(day).isin([d for d in days if d is not None])
    wanted = wanted | F.col(day).isNull() if None in days else wanted
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def inside(df: DataFrame) -> DataFrame:
        same = F.col(day).eqNullSafe(F.col("_day")) & (bucket == F.col("_bucket"))
        return df.filter(wanted).join(parts.select(F.col(day).alias("_day"), F.col("bucket").alias("_bucket")), same, "left_semi")

    hashed = lambda df, sign: inside(df).select(key, F.xxhash64(*columns).alias("h"), F.lit(sign).alias("_sign"))
    by_key = hashed(left, 1).unionByName(hashed(right, -1)).groupBy(key).agg(*_digest_columns("_sign"))
    keys = by_key.filter("row_count <> 0 OR hash_xor <> 0 OR hash_sum <> 0").select(F.col(key).alias("_key"))
    rows = lambda df: inside(df).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return difference(rows(left), rows(right), columns)
