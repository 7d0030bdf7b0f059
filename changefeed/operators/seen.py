"""Which ids of today were there before: a Bloom filter per day, probed before the exact check."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_ID, HASHES = 12, 8
FILTER_DDL = "day date, shard int, id_count bigint, bits binary"


def id_hash(key: str) -> Column:
    return F.xxhash64(key)


def shard_of(hashed: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(hashed, F.lit(1)), F.lit(shards)).cast("int")


def _places(hashed: np.ndarray, size: int) -> np.ndarray:
    """Bits of each hash in a filter of ``size`` bits, a power of two: one row for each hash."""
    h = hashed.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(size - 1)


def _filter(table: pa.Table) -> pa.Table:
    hashed = np.unique(table.column("h").to_numpy())
    size = max(64, 1 << int(len(hashed) * BITS_PER_ID - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[_places(hashed, size).ravel()] = True
    row = [table.column("day")[0], table.column("shard")[0], len(hashed), np.packbits(bits, bitorder="little").tobytes()]
    kinds = [pa.date32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.table([pa.array([v.as_py() if hasattr(v, "as_py") else v], k) for v, k in zip(row, kinds, strict=True)], names=["day", "shard", "id_count", "bits"])


def day_filters(ids: DataFrame, key: str, day: str, shards: int = 16) -> DataFrame:
    """A filter for each day and shard of ids; kept next to the day, and never changed.

    ``shards`` bounds what one task builds: a day's ids divided by it, eight
    bytes each. Null ids are not in it.
    """
    hashed = ids.filter(F.col(key).isNotNull()).select(F.col(day).alias("day"), id_hash(key).alias("h")).distinct()
    rows = hashed.withColumn("shard", shard_of(F.col("h"), shards))
    return rows.groupBy("day", "shard").applyInArrow(_filter, FILTER_DDL)


def _probe(left: pa.Table, right: pa.Table) -> pa.Table:
    """Days of the shard's filters that may hold each hash."""
    hashed = np.unique(left.column("h").to_numpy()) if left.num_rows else np.zeros(0, np.int64)
    found, days = [np.zeros(0, np.int64)], [pa.array([], pa.date32())]
    for k in range(right.num_rows if len(hashed) else 0):
        bits = np.frombuffer(right.column("bits")[k].as_py(), np.uint8)
        places = _places(hashed, 8 * len(bits))
        held = (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1
        own = hashed[held.all(axis=1)]
        found.append(own)
        days.append(pa.array([right.column("day")[k].as_py()] * len(own), pa.date32()))
    return pa.table([pa.array(np.concatenate(found)), pa.concat_arrays(days)], names=["h", "day"])


def candidates(new: DataFrame, key: str, filters: DataFrame, shards: int = 16) -> DataFrame:
    """(h, day): days that may have seen an id of ``new``; none that has is left out.

    Only hashes of new ids and the filters are shuffled, by shard; no history.
    """
    hashed = new.filter(F.col(key).isNotNull()).select(id_hash(key).alias("h")).distinct()
    left = hashed.withColumn("shard", shard_of(F.col("h"), shards)).groupBy("shard")
    kept = filters.select(F.col("shard").alias("of"), "day", "bits").groupBy("of")
    return left.cogroup(kept).applyInArrow(_probe, "h bigint, day date")


def seen_before(new: DataFrame, history: DataFrame, filters: DataFrame, key: str, day: str, shards: int = 16) -> DataFrame:
    """(key, day) for each id of ``new`` and each day of ``history`` that has it: exact.

    ``filters`` are those of the history's days, with the same ``shards``. Of
    the history only days with a candidate are read, and rows whose hash is
    one; the candidates are the smaller side of that join unless most ids
    come back.
    """
    found = candidates(new, key, filters, shards)
    near = history.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(day).alias("_day"), id_hash(key).alias("_h"))
    rows = near.join(found, (F.col("_h") == F.col("h")) & (F.col("_day") == F.col("day")), "left_semi").select("_key", "_day").distinct()
    ids = new.filter(F.col(key).isNotNull()).select(key).distinct()
    return ids.join(rows, F.col(key) == F.col("_key")).select(key, F.col("_day").alias(day))
