"""Verbatim passages of a benchmark in a corpus, by suffix arrays of the corpus.

Every slice of documents is a shard with a suffix array of its own: word
suffixes that begin with three words of some test suffix, sorted by their
first ``window`` words. Every suffix of every benchmark item is searched in it
by bisection; what it finds is compared on for the longest match. Documents
are never shuffled: the benchmark comes to them, in blocks of bounded size.

Words are runs of 0-9, a-z (A-Z lowered) and non-ASCII characters. A window is
``window`` words in a row, or the whole of a shorter item.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.text import NOT_ALNUM, Words, slices

PACK = 3  # words per 64-bit key
BITS = 21


@dataclass(frozen=True)
class Tests:
    """The words of some items and their suffixes that are at least a window long.

    words: sorted hashes of all words; ids: each item word's place in it + 1,
    items after each other; item, at: item number and first word of a suffix;
    depth: words of its window; end: where its item ends.
    """

    names: list[str]
    words: np.ndarray
    ids: np.ndarray
    item: np.ndarray
    at: np.ndarray
    depth: np.ndarray
    end: np.ndarray


def prepare(names: list[str], texts: list[str | None], window: int) -> Tests:
    hashes, counts = [], []
    for part in slices(pa.array(texts, pa.string()), lower=True):
        words = Words(part, NOT_ALNUM)
        hashes.append(words.hashes())
        counts.append(words.counts)
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    words, ids = np.unique(flat, return_inverse=True)
    many = np.where(n >= window, n - window + 1, np.minimum(n, 1))
    item = np.repeat(np.arange(len(n)), many)
    begin = np.cumsum(n) - n
    at = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many) + begin[item]
    return Tests(names, words, ids.astype(np.int64) + 1, item, at, np.minimum(n, window)[item], (begin + n)[item])


def _keys(ids: np.ndarray, at: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """Word ids at..at+width (0 from ``end`` on), PACK to a number, one column per number."""
    columns = []
    for k in range(0, width, PACK):
        key = np.zeros(len(at), np.int64)
        for j in range(k, k + PACK):
            here = at + j
            word = np.where((here < end) & (j < width), ids[np.minimum(here, len(ids) - 1)], 0)
            key = (key << BITS) | word
        columns.append(key)
    return np.stack(columns, axis=1) if columns else np.zeros((len(at), 0), np.int64)


def _bisect(array: np.ndarray, low: np.ndarray, high: np.ndarray, key: np.ndarray, right: bool) -> np.ndarray:
    """Where each key belongs between its own low and high of a sorted column."""
    low, high = low.copy(), high.copy()
    while True:
        todo = np.flatnonzero(low < high)
        if not len(todo):
            return low
        middle = (low[todo] + high[todo]) >> 1
        value = array[middle]
        up = value <= key[todo] if right else value < key[todo]
        low[todo[up]] = middle[up] + 1
        high[todo[~up]] = middle[~up]


def search(tests: Tests, ids: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(test suffix, corpus place, words in common) of every occurrence of a window.

    ids: corpus words as places in ``tests.words`` + 1, 0 for others; end: for
    each corpus word, where its document ends.
    """
    none = (np.zeros(0, np.int64),) * 3
    if not len(tests.at) or not len(ids):
        return none
    # Retained suffixes: their first words begin some test suffix.
    shortest = int(min(PACK, tests.depth.min()))
    heads = np.unique(_keys(tests.ids, tests.at, tests.end, shortest)[:, 0])
    known = ids > 0
    for k in range(1, shortest):
        known[:-k] &= ids[k:] > 0
        known[-k:] = False
    places = np.flatnonzero(known)
    own = _keys(ids, places, end[places], shortest)[:, 0]
    near = np.searchsorted(heads, own)
    places = places[heads[np.minimum(near, len(heads) - 1)] == own]
    if not len(places):
        return none
    # The suffix array of the shard.
    keys = _keys(ids, places, end[places], width)
    order = np.lexsort(keys.T[::-1])
    places, keys = places[order], keys[order]
    # Bisection, PACK words at a time; a window that ends inside a key bounds it on both sides.
    wanted = _keys(tests.ids, tests.at, tests.end, width)
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(places), np.int64)
    for k in range(wanted.shape[1]):
        rest = np.clip(tests.depth - k * PACK, 0, PACK)
        loose = (np.int64(1) << (BITS * (PACK - rest))) - 1
        floor = wanted[:, k] & ~loose
        low, high = (
            _bisect(keys[:, k], low, high, floor, right=False),
            _bisect(keys[:, k], low, high, floor | loose, right=True),
        )
    many = high - low
    suffix = np.repeat(np.arange(len(many)), many)
    place = places[np.arange(len(suffix)) - np.repeat(np.cumsum(many) - many, many) + low[suffix]]
    # Longest matches: on from the window while both sides agree.
    length = tests.depth[suffix].copy()
    todo = np.arange(len(suffix))
    while len(todo):
        here, there = place[todo] + length[todo], tests.at[suffix[todo]] + length[todo]
        inside = (here < end[place[todo]]) & (there < tests.end[suffix[todo]])
        todo, here, there = todo[inside], here[inside], there[inside]
        todo = todo[ids[here] == tests.ids[there]]
        length[todo] += 1
    return suffix, place, length


_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string())), ("matches", pa.list_(_MATCH))])
_TYPE = (
    "n_words long, spans array<array<bigint>>, items array<string>, "
    "matches array<struct<item_id: string, item_start: bigint, start: bigint, length: bigint>>"
)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def find(column: pa.Array, tests: Tests, window: int) -> pa.Array:
    rows = []
    for part in slices(column, lower=True):
        words = Words(part, NOT_ALNUM)
        hashed = words.hashes()
        if len(tests.words):
            near = np.minimum(np.searchsorted(tests.words, hashed), len(tests.words) - 1)
            ids = np.where(tests.words[near] == hashed, near + 1, 0)
        else:
            ids = np.zeros(len(hashed), np.int64)
        end = words.at[1:][words.doc]
        suffix, place, length = search(tests, ids, end, window)
        doc = words.doc[place]
        order = np.lexsort((length, place, tests.item[suffix], doc))
        found: dict[int, tuple[list, set, list]] = {}
        previous = None
        for i in order.tolist():
            d, base = int(doc[i]), int(words.at[doc[i]])
            spans, items, matches = found.setdefault(d, ([], set(), []))
            start, size, item = int(place[i]) - base, int(length[i]), int(tests.item[suffix[i]])
            begins = int(tests.at[suffix[i]] - (tests.end[suffix[i]]))
            spans.append([start, start + size])
            items.add(tests.names[item])
            # A match that goes on from the one a word before is part of it.
            key = (d, item, int(place[i]), begins)
            if previous is None or key != (previous[0], previous[1], previous[2] + 1, previous[3] + 1):
                matches.append({"item_id": tests.names[item], "item_start": begins, "start": start, "length": size})
            previous = key
        for i, n in enumerate(words.counts.tolist()):
            spans, items, matches = found.get(i, ((), (), ()))
            rows.append({"n_words": n, "spans": _merged(list(spans)), "items": sorted(items), "matches": list(matches)})
    return pa.array(rows, _FOUND)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, limit: int) -> list[Tests]:
    """The benchmark in blocks of about ``limit`` characters, each item in one of them."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    items = items.where("id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // limit))
    block = F.pmod(F.xxhash64("id"), F.lit(count))
    result = []
    for k in range(count):
        rows = sorted((r["id"], r["text"]) for r in items.where(block == k).collect())
        result.append(prepare([i for i, _ in rows], [t for _, t in rows], window))
    return result


def match(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    item_col: str = "item_id",
    item_text: str = "text",
    text_col: str = "text",
    out: str = "overlap",
    block_chars: int = 4_000_000,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``out`` of what each text shares with the benchmark.

    n_words; spans: [start, end) words inside matches, merged; items: ids (as
    text, sorted) with a window in the document; matches: longest verbatim
    matches with their places (item_start counts from the item's end, below 0).
    A benchmark larger than ``block_chars`` is passed over the rows in several
    blocks, each a broadcast of bounded size. Null and empty texts have no
    words and match nothing; null items and ids are left out; items with equal
    ids count as one.
    """
    spark = docs.sparkSession
    result = None
    for tests in blocks(benchmark, item_col, item_text, window, block_chars):
        held = spark.sparkContext.broadcast(tests)
        mark = F.arrow_udf(lambda column, held=held: find(column, held.value, window), _TYPE)
        if result is None:
            result = docs.withColumn(out, mark(F.col(text_col)))
            continue
        more = f"{out}_more"
        joined = F.struct(
            F.col(f"{out}.n_words").alias("n_words"),
            F.concat(f"{out}.spans", f"{more}.spans").alias("spans"),
            F.array_sort(F.array_union(f"{out}.items", f"{more}.items")).alias("items"),
            F.concat(f"{out}.matches", f"{more}.matches").alias("matches"),
        )
        result = result.withColumn(more, mark(F.col(text_col))).withColumn(out, joined).drop(more)
    return result


def _union(spans: pa.Array) -> pa.Array:
    return pa.array([sum(b - a for a, b in _merged(s or [])) for s in spans.to_pylist()], pa.int64())


def judged(docs: DataFrame, benchmark: DataFrame, share: int = 20, out: str = "overlap", **options) -> DataFrame:
    """``match`` with n_hit (words inside matches) and contaminated (n_hit > 0, share * n_hit >= n_words) in ``out``."""
    found = match(docs, benchmark, out=out, **options)
    hit = F.arrow_udf(_union, "long")(F.col(f"{out}.spans"))
    with_hit = found.withColumn(out, F.col(out).withField("n_hit", hit))
    bad = (F.col(f"{out}.n_hit") > 0) & (share * F.col(f"{out}.n_hit") >= F.col(f"{out}.n_words"))
    return with_hit.withColumn(out, F.col(out).withField("contaminated", bad))
