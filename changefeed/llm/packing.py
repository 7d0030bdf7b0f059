"""Documents packed into sequences of at most ``capacity`` tokens, best two fit.

A bin is filled greedily with the longest piece that still fits; then its
smallest piece gives way to two unpacked pieces that together fit the gap and
its room more tightly. How bins look depends only on how many pieces of each
length are left, and there are at most ``capacity`` lengths. So the plan is
made on that histogram, each kind of bin with the number of times it can be
repeated; pieces then take their places by their rank among those of their
length. Neither documents nor bins pass through the driver.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changefeed.llm.components import saved
from changefeed.llm.text import BLANKS, Slice, lowered, slices, span_hashes

MEMO_WORDS = 2_000_000


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)  # 0: other, no cut next to it
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1  # letters
    kinds[range(0x30, 0x3A)] = 2  # digits
    signs = [c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]
    kinds[signs] = 3
    return kinds


_KINDS = _byte_kinds()


class Tokens:
    """Token ids of whole texts, each distinct run of characters tokenized once.

    The vocabulary's splitter never joins characters over a blank, nor an
    ASCII letter, a digit or a Latin letter (U+00C0-U+017F but U+00D7, U+00F7
    and U+0130) with another ASCII sign than an apostrophe, nor letters with
    digits. Between such cuts a run has the same ids wherever it stands.
    Texts that spell a special token are tokenized whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.model.get_added_tokens_decoder().values()]
        size = self.model.get_vocab_size()
        self.last = np.array([(self.model.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, runs: list[bytes], letters: np.ndarray) -> None:
        found, who, sizes = [], [], []
        rest, plain = [np.flatnonzero(~letters)], np.flatnonzero(letters)
        for i in range(0, len(plain), 5000):
            some = plain[i : i + 5000]
            ids = np.array(self.encode([b" ".join([runs[k] for k in some.tolist()]).decode()])[0], np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):  # each run of letters is one word of the vocabulary's splitter
                found.append(ids)
                who.append(some)
                sizes.append(np.diff(ends, prepend=0))
            else:
                rest.append(some)
        others = np.concatenate(rest)
        for i in range(0, len(others), 5000):
            some = others[i : i + 5000]
            own = self.encode([runs[k].decode(errors="replace") for k in some.tolist()])
            found.append(np.array([x for ids in own for x in ids], np.uint32))
            who.append(some)
            sizes.append(np.array([len(ids) for ids in own], np.int64))
        size = np.concatenate(sizes)
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *found])
        added = (keys[np.concatenate(who)], at, size)
        self.keys, self.at, self.size = (np.concatenate(x) for x in zip((self.keys, self.at, self.size), added, strict=True))
        order = np.argsort(self.keys)
        self.keys, self.at, self.size = self.keys[order], self.at[order], self.size[order]

    def of(self, original: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents after each other, and where each begins (and the end)."""
        part = Slice(lowered(original.data), original.offsets, original.first)
        data = part.bytes
        kinds = _KINDS[data]
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
        lead = lead[lead + 1 < len(data)]
        follow = data[lead + 1]
        latin = (follow >= 0x80) & (follow < 0xC0)
        latin &= ~((data[lead] == 0xC3) & ((follow == 0x97) | (follow == 0xB7))) & ~((data[lead] == 0xC4) & (follow == 0xB0))
        kinds[lead[latin]] = 1
        kinds[lead[latin] + 1] = 1
        inside = ~BLANKS[data]
        a, b = kinds[:-1], kinds[1:]
        new = np.ones(len(data), bool)
        new[1:] = ~inside[:-1] | ((a != b) & (a > 0) & (b > 0))
        start = np.flatnonzero(inside & new)
        stop = np.ones(len(data), bool)
        stop[:-1] = ~inside[1:] | new[1:]
        end = np.flatnonzero(inside & stop) + 1
        keys, first, inverse = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > MEMO_WORDS:
            self.clear()
        place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        fresh = np.flatnonzero(self.keys[place] != keys) if len(self.keys) else np.arange(len(keys))
        if len(fresh):
            s, e = start[first[fresh]], end[first[fresh]]
            others = np.concatenate([[0], np.cumsum(kinds != 1)])
            self._learn(keys[fresh], [part.data[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)], others[e] == others[s])
            place = np.searchsorted(self.keys, keys)
        size = self.size[place][inverse]
        begin = np.cumsum(size) - size
        total = int(size.sum())
        ids = self.ids[np.repeat(self.at[place][inverse] - begin, size) + np.arange(total)]
        at = np.concatenate([begin, [total]])[np.searchsorted(start, part.offsets)]
        if any(token in part.data for token in self.special):
            texts = []
            for i in range(part.n):
                text = original.text(i)
                whole = any(token in lowered(text) for token in self.special)
                texts.append(np.array(self.encode([text.decode()])[0], np.uint32) if whole else ids[at[i] : at[i + 1]])
            ids, at = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        return ids, at


@cache
def _tokens(path: str) -> Tokens:
    return Tokens(path)


_PIECE = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECE_TYPE = "piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(column: pa.Array, path: str, capacity: int, end_id: int, keep: bool) -> pa.Array:
    fields: dict[str, list] = {"piece": [], "start": [], "length": [], "ids_crc32": []}
    kept, counts = [], []
    for part in slices(column, size=2 << 20):
        ids, at = _tokens(path).of(part)
        for i in range(part.n):
            own = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
            counts.append(-(-len(own) // capacity))
            for k in range(counts[-1]):
                piece = own[k * capacity : (k + 1) * capacity]
                fields["piece"].append(k)
                fields["start"].append(k * capacity)
                fields["length"].append(len(piece))
                fields["ids_crc32"].append(zlib.crc32(piece))
                if keep:
                    kept.append(piece.astype(np.int32))
    arrays, kinds = [pa.array(fields[f.name], f.type) for f in _PIECE], list(_PIECE)
    if keep:
        arrays.append(pa.array(kept, pa.list_(pa.int32())))
        kinds.append(pa.field("ids", pa.list_(pa.int32())))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, fields=kinds))


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, ids: bool = False
) -> DataFrame:
    """id, piece, start, length, ids_crc32 (and the ids): whole texts, only longer ones cut."""
    kind = f"array<struct<{', '.join(f.replace(' ', ': ', 1) for f in _PIECE_TYPE.split(', '))}{', ids: array<int>' if ids else ''}>>"
    cut = F.arrow_udf(lambda column: _pieces(column, tokenizer, capacity, end_id, ids), kind)
    return docs.select(F.col(id_col).alias("doc_id"), cut(F.col(text_col)).alias("_p")).select("doc_id", F.inline("_p"))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Kinds of bins (lengths in order) and how often each is made."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] += count
    lengths = np.arange(capacity + 1)
    kinds: list[tuple[list[int], int]] = []
    top = np.maximum.accumulate(np.where(left > 0, lengths, 0))  # longest piece left of at most this length
    while top[capacity]:
        used: dict[int, int] = {}

        def longest(room: int, also: int = 0, used=used) -> int:
            """Longest piece that fits and is not used up (``also``: one more of that length is taken)."""
            length = int(top[max(0, room)])
            while length and left[length] - used.get(length, 0) - (length == also) <= 0:
                length = int(top[length - 1])
            return length

        items, gap = [], capacity
        while gap and (length := longest(gap)):
            items.append(length)
            used[length] = used.get(length, 0) + 1
            gap -= length
        if gap:
            # Two pieces in the place of the smallest; the tightest pair that is larger than it.
            smallest = items[-1]
            used[smallest] -= 1
            room, best = gap + smallest, (smallest, 0, 0)
            first = longest(room - 1)
            while first and 2 * first > best[0]:
                second = longest(min(first, room - first), first)
                if second and first + second > best[0]:
                    best = (first + second, first, second)
                if best[0] == room:
                    break
                first = longest(first - 1)
            items = items[:-1] + [x for x in best[1:] if x] if best[1] else items
            used = {}
            for x in items:
                used[x] = used.get(x, 0) + 1
        times = min(int(left[x]) // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= times * n
        kinds.append((sorted(items, reverse=True), times))
        if any(left[x] == 0 for x in used):
            top = np.maximum.accumulate(np.where(left > 0, lengths, 0))
    return kinds


def slots(kinds: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first rank, bins, copies in a bin, first bin, offset), sorted by length and rank."""
    rows, taken, bins = [], {}, 0
    for items, times in kinds:
        offset = 0
        for length in dict.fromkeys(items):
            copies = items.count(length)
            rows.append((length, taken.get(length, 0), times, copies, bins, offset))
            taken[length] = taken.get(length, 0) + times * copies
            offset += copies * length
        bins += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def place(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of the rank-th piece of a length."""
    found = np.zeros(len(length), np.int64)
    ends = np.searchsorted(table[:, 0], length, "right")
    begins = np.searchsorted(table[:, 0], length, "left")
    low, high = begins, ends - 1
    while (low < high).any():
        middle = (low + high + 1) // 2
        up = table[middle, 1] <= rank
        low, high = np.where(up, middle, low), np.where(up, high, middle - 1)
    found = table[low]
    copy, bin_ = np.divmod(rank - found[:, 1], found[:, 2])
    return found[:, 4] + bin_, found[:, 5] + copy * found[:, 0]


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """``cut`` (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset.

    ``cut`` is read more than once, so it should be a written table. Pieces of
    one length are ranked within buckets of documents, and the buckets' sizes
    are summed up, so that no length has to fit one task. Repeated rows are
    pieces of their own. Without pieces the result is empty.
    """
    spark = cut.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = cut.withColumn("_b", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "ids_crc32"), F.lit(buckets)))
    sizes = cut.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    # At most ``capacity`` rows, whatever the data.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(counts, capacity)))
    before = F.sum("_n").over(W.partitionBy("length").orderBy("_b")) - F.col("_n")
    sizes = sizes.select("length", "_b", before.alias("_before"))
    rank = F.row_number().over(W.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = cut.withColumn("_rank", rank).join(sizes, ["length", "_b"])

    def put(length: pa.Array, order: pa.Array) -> pa.Array:
        bins, offsets = place(table.value, length.to_numpy(zero_copy_only=False), order.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(bins), pa.array(offsets)], ["sequence_id", "offset"])

    at = F.arrow_udf(put, "sequence_id bigint, offset bigint")(F.col("length"), (F.col("_rank") + F.col("_before")).cast("long"))
    placed = ranked.withColumn("_at", at)
    return placed.select(*[c for c in cut.columns if c != "_b"], "_at.sequence_id", "_at.offset")


def packed(docs: DataFrame, tokenizer: str, capacity: int = 4096, **options) -> DataFrame:
    """Cut, write the pieces to shared storage, plan and place them.

    Null texts count as empty: a piece of the end token alone.
    """
    return pack(saved(pieces(docs, tokenizer, capacity=capacity, **options), "pieces"), capacity)
