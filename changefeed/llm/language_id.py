"""Language by cross-parsing: the language whose text parses a document into fewest phrases.

For every language a suffix automaton recognises each substring of its
training text. A document is read from left to right; a phrase is the longest
match from the present place, or one byte where none exists. The entropy
estimate of a language is phrases * log2(training bytes) / document bytes;
the smallest wins, ties go to the first language by name.

Text is lower-cased and runs of ASCII non-letters become one blank. Parsing
starts anew every ``BLOCK`` bytes, which adds at most one phrase to each block
for every language alike and lets numpy parse thousands of blocks in step,
long documents included, whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.text import Slice, per_doc, slices

BLOCK = 256
_LETTER = r"\p{L}"
_PLAIN = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x0A if c == 0x0A else 0x20 for c in range(256))
UNKNOWN = "und"


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        now = len(moves)
        moves.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = now
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if size[p] + 1 == size[q]:
                link[now] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return moves


@dataclass(frozen=True)
class Languages:
    """Names in order and a training text for each."""

    names: tuple[str, ...]
    texts: tuple[bytes, ...]


@cache
def _tables(model: Languages):
    """Byte classes, and per language the table state x class of next states + 1 (0: none)."""
    used = sorted(set(b"".join(model.texts)))
    classes = np.full(256, 1, np.uint8)  # 0: padding, 1: bytes seen in no training text
    classes[used] = np.arange(2, len(used) + 2)
    width, tables = len(used) + 2, []
    for text in model.texts:
        moves = suffix_automaton(text)
        table = np.zeros((len(moves) + 1, width), np.int32)  # row s + 1 is state s
        for s, move in enumerate(moves):
            for c, to in move.items():
                table[s + 1, classes[c]] = to + 1
        table[:, 0] = np.arange(len(table))  # padding changes nothing
        tables.append(table.ravel())
    return classes, width, tables


def plain(part: Slice) -> Slice:
    """Letters and single blanks; documents still end by a newline."""
    data = np.frombuffer(part.data.translate(_PLAIN), np.uint8).copy()
    data[part.offsets[1:] - 1] = 0x0A
    inner = np.flatnonzero(data == 0x0A)
    inner = inner[~np.isin(inner, part.offsets[1:] - 1, assume_unique=True)]
    data[inner] = 0x20
    blank = data == 0x20
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & (blank[:-1] | (data[:-1] == 0x0A)))
    keep[:1] = ~blank[:1]
    before = np.concatenate([[0], np.cumsum(keep)])
    return Slice(data[keep].tobytes(), before[part.offsets], part.first)


def phrases(part: Slice, model: Languages) -> np.ndarray:
    """Phrases of each document (row) in each language (column)."""
    classes, width, tables = _tables(model)
    size = np.diff(part.offsets) - 1
    many = -(-size // BLOCK)
    doc = np.repeat(np.arange(part.n), many)
    begin = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * BLOCK + part.offsets[:-1][doc]
    stop = np.minimum(begin + BLOCK, part.offsets[1:][doc] - 1)
    coded = np.concatenate([classes[part.bytes], np.zeros(BLOCK, np.uint8)])
    grid = coded[begin[:, None] + np.arange(BLOCK)]
    grid[np.arange(BLOCK) >= (stop - begin)[:, None]] = 0
    grid = np.ascontiguousarray(grid.T).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(many)])
    result = np.zeros((part.n, len(tables)), np.int64)
    for k, table in enumerate(tables):
        root = table[width : 2 * width].copy()
        root[root == 0] = 1  # a byte that the language lacks is a phrase by itself
        state, count = np.ones(len(doc), np.int64), np.zeros(len(doc), np.int64)
        for column in grid:
            moved = table[state * width + column]
            miss = np.flatnonzero(moved == 0)
            c = column[miss]
            # The phrase ends before this byte, or with it where it stood alone.
            count[miss] += state[miss] != 1
            moved[miss] = root[c]
            count[miss] += table[width + c] == 0
            state = moved.astype(np.int64)
        result[:, k] = per_doc(count + (state != 1), at)
    return result


def predict(column: pa.Array, model: Languages) -> tuple[list[str], np.ndarray]:
    """A language and a score in 0..1 (lead over the second language) for each text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    lettered = pc.match_substring_regex(column, _LETTER).to_numpy(zero_copy_only=False)
    names, scores = [], []
    for part in slices(pc.utf8_lower(column)):
        part = plain(part)
        known = lettered[part.first : part.first + part.n]
        if not model.names:
            names += [UNKNOWN] * part.n
            scores.append(np.zeros(part.n))
            continue
        bits = np.log2(np.array([len(t) for t in model.texts]) + 1.0)
        cost = phrases(part, model) * bits
        best = cost.argmin(axis=1)
        ordered = np.sort(cost, axis=1)
        lead = 1 - ordered[:, 0] / np.maximum(ordered[:, 1], 1e-9) if cost.shape[1] > 1 else np.ones(part.n)
        names += [model.names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        scores.append(np.where(known, np.clip(lead, 0, 1), 0.0))
    return names, np.concatenate(scores) if scores else np.zeros(0)


def train(
    docs: DataFrame,
    where: Column | None = None,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = 60,
    letters: int = 24_000,
) -> Languages:
    """Training text of each language: whole documents by a hash of their id, at most
    ``sample`` documents and ``letters`` bytes a language (the last one is cut there)."""
    rows = docs if where is None else docs.where(where)
    rows = rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    rows = rows.where(F.col("_text").rlike(_LETTER) & F.col("_lang").isNotNull())
    counts = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    if not counts:
        return Languages((), ())
    place = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(5)), F.lit(1 << 30))
    limit = F.lit(0)
    for name, total in counts.items():
        share = min(1.0, 1.3 * sample / total + 32 / total)
        limit = F.when(F.col("_lang") == name, int((1 << 30) * share)).otherwise(limit)
    found = rows.withColumn("_place", place).where(F.col("_place") <= limit)
    texts: dict[str, list[tuple]] = {}
    for r in found.orderBy("_place", "_id", "_text").limit(len(counts) * (2 * sample + 64)).collect():
        texts.setdefault(r["_lang"], []).append((r["_place"], r["_text"]))
    names, joined = [], []
    for name in sorted(texts):
        own = [t for _, t in texts[name]][:sample]
        data = b" ".join(plain(p).data.replace(b"\n", b" ") for p in slices(pc.utf8_lower(pa.array(own))))
        names.append(name)
        joined.append(data[:letters])
    return Languages(tuple(names), tuple(joined))


def identify(docs: DataFrame, model: Languages, text_col: str = "text", out: str = "language") -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: lang_pred, score.

    Null texts and texts without a letter get ``und`` and 0. An untrained
    model (empty table) gives ``und`` for all.
    """

    def apply(column: pa.Array) -> pa.Array:
        names, scores = predict(column, model)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    return docs.withColumn(out, F.arrow_udf(apply, "lang_pred string, score double")(F.col(text_col)))
