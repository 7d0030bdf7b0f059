"""Documents packed into windows of several lengths, the gaps of long windows filled from shorter tiers.

A document (a whole multiple of ``capacity`` fills windows of its own) belongs
to the tier of the shortest window that holds it. Tiers are packed from the
longest window to the shortest: a window takes one document of its tier, then
the longest shorter ones that fit its gap, and what is left of the gap is the
beginning of one more document, whose rest goes on as a document of its length.
So windows are full, whatever their length, and a window has one cut at most.
The last documents of all fill windows of the powers of two that make up their
sum.

How a window looks depends only on how many documents of each length are left.
The plan is made on that histogram of ``capacity`` numbers, each kind of window
with the number of times it is repeated; a document finds its places by its
rank among those of its length, a cut one again by the rank of its rest. Token
ids move once, to be ranked; no document or window passes through the driver.

Windows of a tier are dealt to steps of equal tokens in turn: steps of a tier
differ by one window at most, and documents of all lengths are spread over them.

Cases: null and empty texts are the end token alone; repeated rows are
documents of their own; ties of length are ranked by id, then by content;
without rows the result is empty. Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window as W

from changefeed.llm.blobs import binary
from changefeed.llm.chunks import Numbers, chunks, ranges
from changefeed.llm.components import saved
from changefeed.llm.text import BLANKS, Slice, lowered, per_doc, slices

#: Distinct runs (and bytes of them) that a worker remembers between slices.
MEMO_RUNS, MEMO_BYTES = 500_000, 24 << 20
JOINED = 5_000

_LETTERS, _DIGITS, _SIGNS, _BLANK = 1, 2, 3, 4


def _byte_kinds() -> np.ndarray:
    kinds = np.where(BLANKS, _BLANK, 0).astype(np.uint8)  # 0: others, cut from blanks alone
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTERS
    kinds[range(0x30, 0x3A)] = _DIGITS
    kinds[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = _SIGNS
    return kinds


_KINDS = _byte_kinds()


def kinds_of(data: np.ndarray) -> np.ndarray:
    """Kind of each byte; Latin letters of two bytes (U+00C0-U+017F but two signs and U+0130) are letters."""
    kinds = _KINDS[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    first, second = data[lead], data[lead + 1]
    sign = (first == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (first == 0xC4) & (second == 0xB0)
    lead = lead[~sign]
    kinds[lead] = kinds[lead + 1] = _LETTERS
    return kinds


class WordIds:
    """Token ids of texts; each distinct run of letters, digits, signs or blanks is encoded once.

    The vocabulary's splitter drops blanks and joins nothing over them, nor
    letters, digits and signs (but the apostrophe) with each other, and it
    lowers letters. Texts that spell a special token are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.model.get_added_tokens_decoder().values()]
        size = self.model.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.last = np.array([(self.model.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.numbers = Numbers(MEMO_RUNS, MEMO_BYTES)
        self.clear()

    def clear(self) -> None:
        self.numbers.clear()
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, runs: list[bytes]) -> None:
        length = np.array([len(r) for r in runs], np.int64)
        kinds = kinds_of(np.frombuffer(b"".join(runs), np.uint8))
        at = np.cumsum(length) - length
        low, high = np.minimum.reduceat(kinds, at), np.maximum.reduceat(kinds, at)
        # Words that the splitter makes of a run: digits stand alone.
        words = np.where(low != high, 0, np.where(high == _DIGITS, length, ((high == _LETTERS) | (high == _SIGNS)).astype(np.int64)))
        plain = np.flatnonzero(words)
        rest, found, sizes, who = [np.flatnonzero((words == 0) & (high != _BLANK))], [], [], []
        for i in range(0, len(plain), JOINED):
            some = plain[i : i + JOINED]
            ids = np.array(self.encode([b" ".join([runs[k] for k in some.tolist()]).decode()])[0], np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != words[some].sum():
                rest.append(some)
                continue
            found.append(ids)
            sizes.append(np.diff(ends[np.cumsum(words[some]) - 1], prepend=0))
            who.append(some)
        others = np.concatenate(rest)
        own = self.encode([runs[k].decode() for k in others.tolist()])
        found += [np.array(x, np.uint32) for x in own]
        sizes.append(np.array([len(x) for x in own], np.int64))
        who.append(others)
        who = np.concatenate(who)
        size = np.zeros(len(runs), np.int64)
        size[who] = np.concatenate(sizes)
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        # In the order of the runs' numbers.
        begin = np.zeros(len(runs), np.int64)
        begin[who] = np.cumsum(size[who]) - size[who]
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids[ranges(begin, size)]])

    def of(self, original: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice after each other, and how many each has."""
        part = Slice(lowered(original.data), original.offsets, original.first)
        kinds = kinds_of(part.bytes)
        new = np.ones(len(kinds), bool)
        a, b = kinds[:-1], kinds[1:]
        new[1:] = (a != b) & ((a > 0) & (b > 0) | (a == _BLANK) | (b == _BLANK))
        local, found, at = chunks(part, new)
        if self.numbers.full:
            self.clear()
        numbers, fresh = self.numbers.of(found)
        if fresh:
            self.learn(fresh)
        begin = np.cumsum(self.size) - self.size
        run = numbers[local]
        ids, size = self.ids[ranges(begin[run], self.size[run])], per_doc(self.size[run], at)
        if any(token in part.data for token in self.special):
            texts = np.split(ids, np.cumsum(size)[:-1])
            for i in range(part.n):
                if any(token in part.text(i) for token in self.special):
                    texts[i] = np.array(self.encode([original.text(i).decode()])[0], np.uint32)
            ids, size = np.concatenate(texts), np.array([len(t) for t in texts], np.int64)
        return ids, size


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def items(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids): whole documents with the end token, longer ones cut at multiples of ``capacity``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    numbers = [StructField(k, LongType()) for k in ("doc_tokens", "start", "length")]
    schema = StructType([rows.schema["doc_id"], *numbers, StructField("ids", BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _word_ids(tokenizer)
        for batch in batches:
            for part in slices(batch["text"], size=2 << 20):
                ids, size = model.of(part)
                ids = np.insert(ids, np.cumsum(size), end_id)
                size = size + 1
                many = -(-size // capacity)
                doc = np.repeat(np.arange(part.n), many)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * capacity
                length = np.minimum(size[doc] - start, capacity)
                at = np.concatenate([[0], np.cumsum(length)])
                names = batch["doc_id"].slice(part.first, part.n).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([names, pa.array(size[doc]), pa.array(start), pa.array(length), binary(ids.astype(model.kind), at)], names=schema.names)

    return rows.mapInArrow(cut, schema)


class Plan:
    """Kinds of windows for a histogram of lengths, and where the n-th document of a length goes.

    ``table`` has a row for each place in a kind: length, first rank, windows,
    tokens taken (fewer than the length: a cut), first window, offset, first
    rank of the rests. ``windows``: size, first window, windows, first step, steps.
    """

    def __init__(self, counts: dict[int, int], capacity: int = 4096, tiers: int = 5, step_windows: int = 16):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.left[length] += count
        self.total, self.capacity = self.left.copy(), capacity
        self.rows: list[tuple[int, ...]] = []
        self.bins, sizes = 0, []
        for k in range(tiers):
            size, first = capacity >> k, self.bins
            rest = self.fill(size, 0 if k == tiers - 1 else size >> 1)
            sizes.append((size, first, self.bins - first))
            if rest:
                sizes += self.end(rest)
                break
        self.table = np.array(sorted(self.rows), np.int64).reshape(-1, 7)
        steps, self.windows = 0, []
        for size, first, n in sizes:
            per_step = step_windows * capacity // size
            self.windows.append((size, first, n, steps, -(-n // per_step)))
            steps += self.windows[-1][-1]
        self.steps = np.array(self.windows, np.int64).reshape(-1, 5)
        # Of windows that none was made of, the first number is that of the next ones.
        self.steps = self.steps[self.steps[:, 2] > 0]

    def take(self, length: int, times: int, copies: int, offset: int, size: int | None = None) -> None:
        """Puts the next documents of a length into the next ``times`` windows; ``size``: only that many of their tokens."""
        first, rest = int(self.total[length] - self.left[length]), -1
        self.left[length] -= times * copies
        if size is None:
            for k in range(copies):
                self.rows.append((length, first + k * times, times, length, self.bins, offset + k * length, -1))
            return
        rest = int(self.total[length - size])
        self.total[length - size] += times
        self.left[length - size] += times
        self.rows.append((length, first, times, size, self.bins, offset, rest))

    def fill(self, size: int, low: int) -> list[int]:
        """Windows of a size until no document longer than ``low`` is left; returns the lengths of the last ones if they fill none."""
        lengths = np.arange(self.capacity + 1)
        while True:
            # The longest length left of at most each length.
            top = np.maximum.accumulate(np.where(self.left > 0, lengths, 0))
            longest = int(top[size])
            if longest <= low:
                return []
            used: dict[int, int] = {}

            def best(room: int, used=used, top=top) -> int:
                length = int(top[room])
                while length and self.left[length] <= used.get(length, 0):
                    length = int(top[length - 1])
                return length

            gap = size
            while gap and (length := best(gap)):
                used[length] = used.get(length, 0) + 1
                gap -= length
            # None fits the gap, so all others are longer: the longest of a shorter tier is cut, else the shortest of this one.
            cut = best(low) if gap else 0
            if gap and not cut:
                longer = np.flatnonzero(self.left > 0)
                longer = [x for x in longer.tolist() if x > gap and self.left[x] > used.get(x, 0)]
                if not longer:
                    return [x for x, n in used.items() for _ in range(n)]
                cut = longer[0]
            need = used | ({cut: used.get(cut, 0) + 1} if cut else {})
            times = min(int(self.left[x]) // n for x, n in need.items())
            offset = 0
            for x, n in used.items():
                self.take(x, times, n, offset)
                offset += n * x
            if cut:
                self.take(cut, times, 1, offset, gap)
            self.bins += times

    def end(self, rest: list[int]) -> list[tuple[int, int, int]]:
        """The last documents, one after the other, in windows of the powers of two of their sum."""
        sizes, total = [], sum(rest)
        for k in reversed(range(total.bit_length())):
            if not total >> k & 1:
                continue
            room = 1 << k
            sizes.append((room, self.bins, 1))
            while room:
                length = rest.pop(0)
                size = min(length, room)
                self.take(length, 1, 1, (1 << k) - room, None if size == length else size)
                room -= size
                if size < length:
                    rest.insert(0, length - size)
            self.bins += 1
        return sizes

    def places(self, length: np.ndarray, rank: np.ndarray) -> dict[str, np.ndarray]:
        """Pieces of documents: document, start, length, sequence_id, offset, window, step."""
        found: list[list[np.ndarray]] = []
        doc, start = np.arange(len(length)), np.zeros(len(length), np.int64)
        key = self.table[:, 0] << 48 | self.table[:, 1]
        while len(doc):
            row = self.table[np.searchsorted(key, length << 48 | rank, "right") - 1]
            nth = rank - row[:, 1]
            found.append([doc, start, row[:, 3], row[:, 4] + nth, row[:, 5]])
            more = row[:, 6] >= 0
            doc, start, length, rank = doc[more], (start + row[:, 3])[more], (length - row[:, 3])[more], (row[:, 6] + nth)[more]
        doc, start, length, window, offset = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5
        tier = self.steps[np.searchsorted(self.steps[:, 1], window, "right") - 1] if len(window) else np.zeros((0, 5), np.int64)
        step = tier[:, 3] + (window - tier[:, 1]) % np.maximum(tier[:, 4], 1)
        return {"doc": doc, "start": start, "length": length, "sequence_id": window, "offset": offset, "window": tier[:, 0], "step": step}


PIECE = ("start", "length", "ids_crc32", "sequence_id", "offset", "window", "step")


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, tiers: int = 5, step_windows: int = 16, ids: bool = False, **columns
) -> DataFrame:
    """Per piece doc_id, doc_tokens, start, length, ids_crc32, sequence_id, offset, window (its length), step (and the ids).

    A step has the tokens of ``step_windows`` windows of ``capacity``.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = saved(items(docs, tokenizer, capacity, end_id, **columns), "items")
    cut = cut.withColumn("_b", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "start", "ids"), F.lit(buckets)))
    sizes = cut.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    # At most ``capacity`` rows, whatever the data.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # A row for each place in a kind of window; their number depends on the lengths, not on the rows.
    plan = spark.sparkContext.broadcast(Plan(counts, capacity, tiers, step_windows))
    before = F.sum("_n").over(W.partitionBy("length").orderBy("_b")) - F.col("_n")
    sizes = sizes.select("length", "_b", before.alias("_before"))
    rank = F.row_number().over(W.partitionBy("length", "_b").orderBy("doc_id", "start", "ids")) - 1
    ranked = cut.withColumn("_rank", rank).join(sizes, ["length", "_b"])
    fields = [(name, pa.int64()) for name in PIECE] + ([("ids", pa.list_(pa.uint32()))] if ids else [])
    kind = f"array<struct<{', '.join(f'{name}: bigint' for name in PIECE)}{', ids: array<bigint>' if ids else ''}>>"
    fields = [(name, pa.list_(pa.int64()) if name == "ids" else t) for name, t in fields]

    def put(length: pa.Array, rank: pa.Array, start: pa.Array, values: pa.Array) -> pa.Array:
        found = plan.value.places(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        width = _word_ids(tokenizer).kind
        own = [np.frombuffer(v, width).astype("<u4") for v in values.to_pylist()]
        pieces = [own[d][s : s + n] for d, s, n in zip(found["doc"].tolist(), found["start"].tolist(), found["length"].tolist(), strict=True)]
        found["ids_crc32"] = np.array([zlib.crc32(p) for p in pieces], np.int64)
        found["start"] = found["start"] + start.to_numpy(zero_copy_only=False)[found["doc"]]
        order = np.lexsort((found["start"], found["doc"]))
        arrays = [pa.array(found[name][order]) for name in PIECE]
        if ids:
            arrays.append(pa.array([pieces[k].astype(np.int64) for k in order.tolist()], pa.list_(pa.int64())))
        at = np.concatenate([[0], np.cumsum(np.bincount(found["doc"], minlength=len(length)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(arrays, fields=[pa.field(*f) for f in fields]))

    pieces = F.arrow_udf(put, kind)("length", (F.col("_rank") + F.col("_before")).cast("long"), "start", "ids")
    return saved(ranked.select("doc_id", "doc_tokens", pieces.alias("_p")).select("doc_id", "doc_tokens", F.inline("_p")), "packed")
