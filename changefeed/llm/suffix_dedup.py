"""Passages that several documents share, found with sparse suffix arrays.

A suffix of a document (all words from a place on) is retained where its first
``SEED`` words have the smallest hash among ``span`` neighbours in a row: the
choice depends on content alone, so two copies of a passage retain the same
places. With ``span = least - HEAD + 1`` neighbours, every run of ``least``
words has a retained suffix among its first ``span`` places.

Retained suffixes are sorted by what they begin with. Neighbours with the
same ``HEAD`` words are a class; classes within one document are dropped. The
members of a class are then extended to the left and right: where the whole
surroundings (``span - 1`` words before, ``least`` from the place on) occur in
another document, the surroundings are repeated; else each run of ``least``
words whose first retained suffix this is goes into a comparison of runs, if
no retained suffix inside it is known to be alone. There the smallest and the
largest document stand for repeated surroundings of the same class. What is found are exactly
the words inside a run of ``least`` words that another document holds.

Documents fall into buckets by hash. A bucket lists its suffixes, one entry
for each class and surroundings with the smallest and the largest document; a
shard of classes sorts the lists of all buckets, compares neighbours and
answers in the lists' order; a bucket meets its answers and extends. So a
class of any size is one entry for each bucket, and nothing is paired.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.blobs import flat, planes, unplanes
from changefeed.llm.components import saved
from changefeed.llm.text import BLANKS, Windows, Words, mixed, slices

SEED = 8
HEAD = 20


class Suffixes:
    """Retained suffixes of some texts, and the runs of ``least`` words with the suffix that stands for each."""

    def __init__(self, texts: pa.ChunkedArray, doc: np.ndarray, least: int):
        span = least - HEAD + 1
        fields: dict[str, list] = {name: [] for name in ("doc", "low", "high", "head", "around", "run_owner", "run_last", "run_at", "run")}
        count = 0
        for part in slices(texts):
            words = Words(part, BLANKS)
            grams = len(words.start) - SEED + 1
            if grams < span:
                continue
            sums = Windows(words.hashes())
            first = np.arange(grams)
            value = sums.of(first, first + SEED)
            owner = np.lib.stride_tricks.sliding_window_view(value, span).argmin(axis=1) + np.arange(grams - span + 1)
            end = words.at[1:][words.doc]
            at = np.arange(len(owner))
            sight = np.flatnonzero(at + span + SEED - 1 <= end[: len(owner)])  # neighbours inside one document
            start = np.flatnonzero(at + least <= end[: len(owner)])  # runs inside one document
            place, number = np.unique(owner[sight], return_inverse=True)
            chosen = np.full(len(owner), -1)
            chosen[sight] = number
            mine = chosen[start]
            # What a run holds decides on its suffixes up to here, heads included.
            last = np.minimum(chosen[start + HEAD - SEED], np.searchsorted(place, start + least - HEAD, "right") - 1)
            rows = words.doc[place]
            low, high = np.maximum(words.at[rows], place - span + 1), np.minimum(words.at[rows + 1], place + least)
            base = words.at[rows]
            fields["doc"].append(doc[rows + part.first])
            fields["low"].append(low - base)
            fields["high"].append(high - base)
            fields["head"].append(sums.of(place, np.minimum(place + HEAD, words.at[rows + 1])))
            fields["around"].append(mixed(sums.of(low, high) + (place - low).astype(np.uint64)))
            fields["run_owner"].append(mine + count)
            fields["run_last"].append(last + count)
            fields["run_at"].append(start - base[mine])
            fields["run"].append(sums.of(start, start + least).view(np.int64))
            count += len(place)
        kinds = {"head": np.uint64, "around": np.uint64}
        for name, found in fields.items():
            setattr(self, name, np.concatenate(found) if found else np.zeros(0, kinds.get(name, np.int64)))
        # Entries: distinct (head, around) in order, with their smallest and largest document.
        order = np.lexsort((self.around, self.head))
        head, around = self.head[order], self.around[order]
        new = np.ones(len(order), bool)
        new[1:] = (head[1:] != head[:-1]) | (around[1:] != around[:-1])
        begin = np.flatnonzero(new)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.heads, self.arounds = head[begin], around[begin]
        self.least_doc = np.minimum.reduceat(self.doc[order], begin) if len(begin) else self.doc
        self.most_doc = np.maximum.reduceat(self.doc[order], begin) if len(begin) else self.doc

    def cuts(self, shards: int) -> np.ndarray:
        shard = ((self.heads >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        return np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))


_ASK = "shard int, bucket int, heads binary, arounds binary, least_doc binary, gap binary"
_ANSWER = "bucket int, shard int, codes binary, first_doc binary, last_doc binary"
_FOUND = "doc bigint, start bigint, end bigint, first_doc bigint, run bigint"
ALONE, FULL, UNSURE, STANDS = range(4)


def _ask(table: pa.Table, shards: int, least: int) -> pa.Table:
    found = Suffixes(table.column("text"), table.column("doc").to_numpy(), least)
    at, bucket = found.cuts(shards), table.column("bucket")[0].as_py()
    rows = [
        (
            s,
            bucket,
            found.heads[a:b].tobytes(),
            found.arounds[a:b].tobytes(),
            planes(found.least_doc[a:b], 8),
            planes(found.most_doc[a:b] - found.least_doc[a:b], 8),
        )
        for s, a, b in zip(range(shards), at[:-1], at[1:], strict=True)
    ]
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 4
    names = [x.split()[0] for x in _ASK.split(", ")]
    return pa.table({n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(zip(names, kinds, strict=True))})


def _answer(table: pa.Table) -> pa.Table:
    """Of one shard: what each entry is. Sorted entries, neighbours compared."""
    heads, counts = flat(table.column("heads"), np.uint64)
    arounds, _ = flat(table.column("arounds"), np.uint64)
    low = np.concatenate([unplanes(x, 8).view(np.int64) for x in table.column("least_doc").to_pylist()])
    high = low + np.concatenate([unplanes(x, 8).view(np.int64) for x in table.column("gap").to_pylist()])
    order = np.lexsort((arounds, heads))
    codes, first, final = np.zeros(len(order), np.uint8), np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    if len(order):
        h, a = heads[order], arounds[order]
        new_head = np.ones(len(order), bool)
        new_head[1:] = h[1:] != h[:-1]
        new = new_head.copy()
        new[1:] |= a[1:] != a[:-1]
        begin, head_begin = np.flatnonzero(new), np.flatnonzero(new_head)
        least, most = np.minimum.reduceat(low[order], begin), np.maximum.reduceat(high[order], begin)
        full = least != most
        head_of = (np.cumsum(new_head) - 1)[begin]
        groups = np.searchsorted(head_of, np.arange(len(head_begin)))
        shared = np.minimum.reduceat(least, groups) != np.maximum.reduceat(most, groups)
        all_full = np.minimum.reduceat(full, groups)
        code = np.where(full, np.where(all_full[head_of], FULL, STANDS), UNSURE)
        code = np.where(shared[head_of], code, ALONE)
        group = np.cumsum(new) - 1
        codes[order], first[order], final[order] = code[group], least[group], most[group]
    ends = np.cumsum(counts)
    out: dict[str, list] = {"bucket": table.column("bucket").to_pylist(), "shard": table.column("shard").to_pylist(), "codes": [], "first_doc": [], "last_doc": []}
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        out["codes"].append(codes[a:b].tobytes())
        out["first_doc"].append(first[a:b][codes[a:b] != ALONE].tobytes())
        out["last_doc"].append(final[a:b][codes[a:b] == STANDS].tobytes())
    return pa.table({n: pa.array(v, pa.int32() if n in ("bucket", "shard") else pa.binary()) for n, v in out.items()})


def _extend(docs: pa.Table, answers: pa.Table, least: int) -> pa.Table:
    """Of one bucket: repeated surroundings, merged (run is null), and the runs still to be compared."""
    found = Suffixes(docs.column("text"), docs.column("doc").to_numpy(), least)
    answers = answers.sort_by("shard")
    codes, _ = flat(answers.column("codes"), np.uint8)
    first, final = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    first[codes != ALONE] = flat(answers.column("first_doc"), np.int64)[0]
    final[codes == STANDS] = flat(answers.column("last_doc"), np.int64)[0]
    code, first, final = codes[found.entry], first[found.entry], final[found.entry]
    full = np.flatnonzero(((code == FULL) | (code == STANDS)) & (found.high - found.low >= least))
    doc, low, high = found.doc[full], found.low[full], found.high[full]
    new = np.ones(len(full), bool)
    # Within a document both ends rise; a lower start is another row of the same id.
    new[1:] = (doc[1:] != doc[:-1]) | (low[1:] > high[:-1]) | (low[1:] < low[:-1]) | (high[1:] < high[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(full)) - 1
    smallest = np.minimum.reduceat(first[full], begin) if len(begin) else np.zeros(0, np.int64)
    # Runs whose suffix is unsure, or stands for its surroundings, and that hold no suffix that is alone.
    # Two documents stand, so that each also meets the other's runs where it is unsure itself.
    owner = found.run_owner
    stands = (found.doc[owner] == first[owner]) | (found.doc[owner] == final[owner])
    wanted = (code[owner] == UNSURE) | ((code[owner] == STANDS) & stands)
    alone = np.concatenate([[0], np.cumsum(code == ALONE)])
    own = owner[wanted]
    clear = alone[found.run_last[wanted] + 1] == alone[own]
    at, run, mine = found.run_at[wanted][clear], found.run[wanted][clear], own[clear]
    return pa.table(
        {
            "doc": pa.array(np.concatenate([doc[begin], found.doc[mine]])),
            "start": pa.array(np.concatenate([low[begin], at])),
            "end": pa.array(np.concatenate([high[last], at + least])),
            "first_doc": pa.array(np.concatenate([smallest, found.doc[mine]])),
            "run": pa.array(np.concatenate([np.zeros(len(begin), np.int64), run]), mask=np.arange(len(begin) + len(run)) < len(begin)),
        }
    )


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_doc", pa.int64())])


def _merge(lists: pa.Array) -> pa.Array:
    out = []
    for own in lists.to_pylist():
        merged: list[dict] = []
        for span in sorted(own, key=lambda s: (s["start"], s["end"])):
            if merged and span["start"] <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], span["end"])
                merged[-1]["first_doc"] = min(merged[-1]["first_doc"], span["first_doc"])
            else:
                merged.append(dict(span))
        out.append(merged)
    return pa.array(out, pa.list_(_SPAN))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50) -> DataFrame:
    """Passages of ``least`` words or more that another document holds too.

    A row per passage: doc_id, start_word, end_word (exclusive), n_words,
    first_doc_id (smallest id met while extending it). Ids must be integers. Words are runs
    of characters other than ASCII blanks, compared as written. Passages that
    overlap or touch are one row. Repeats within one document alone do not
    count; rows with the same id are one document. Null and short
    texts and rows without an id have no passages.
    """
    if least < HEAD + SEED:
        raise ValueError(f"least must be {HEAD + SEED} or more")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).dropna()
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc", "text"), F.lit(parts)).cast("int"))
    asked = rows.groupBy("bucket").applyInArrow(lambda t: _ask(t, parts, least), _ASK)
    answers = asked.groupBy("shard").applyInArrow(_answer, _ANSWER)
    found = rows.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(lambda d, a: _extend(d, a, least), _FOUND)
    found = saved(found, "extended")
    runs = found.where("run IS NOT NULL")
    twice = runs.groupBy("run").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least != most")
    more = runs.drop("first_doc").join(twice.select("run", F.col("least").alias("first_doc")), "run")
    spans = found.where("run IS NULL").select("doc", "start", "end", "first_doc").unionByName(more.select("doc", "start", "end", "first_doc"))
    lists = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end", "first_doc")).alias("spans"))
    merged = lists.select("doc", F.inline(F.arrow_udf(_merge, "array<struct<start: bigint, end: bigint, first_doc: bigint>>")("spans")))
    return merged.select(
        F.col("doc").alias("doc_id"),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
        F.col("first_doc").alias("first_doc_id"),
    )
