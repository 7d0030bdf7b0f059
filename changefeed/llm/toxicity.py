"""Toxicity by subword embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (bytes of the lower-cased word
between markers) and itself, hashed to buckets that each hold a vector. A
passage of ``PASSAGE`` words is the mean of its words' means, and a linear
softmax gives two classes. Vectors and softmax are trained together. A
document is as toxic as its worst passage, so a long text does not drown a
few words; in training each document teaches by its worst passage of the
moment. Unseen spellings are read through the n-grams they share.

With the softmax linear, a bucket's vector enters a score only through one
number, its product with the difference of the two class vectors: that number
per bucket is what scoring uses.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.sampling import labelled_texts
from changefeed.llm.text import NOT_ALNUM, Slice, Words, mixed, slices

BUCKETS = 1 << 17
DIMENSIONS = 4
PASSAGE = 4
GRAMS = (4, 5, 6)


class Bags:
    """Distinct words of a slice with their buckets, and passages of words."""

    def __init__(self, part: Slice):
        words = Words(part, NOT_ALNUM)
        hashed = words.hashes()
        self.distinct, first, self.word = np.unique(hashed, return_index=True, return_inverse=True)
        self._grams(part, words.start[first], words.end[first], self.distinct)
        counts = words.counts
        many = -(-counts // PASSAGE)
        doc = np.repeat(np.arange(part.n), many)
        self.begin = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * PASSAGE + words.at[:-1][doc]
        self.stop = np.minimum(self.begin + PASSAGE, words.at[1:][doc])
        self.doc, self.passages, self.n = doc, many, part.n

    def _grams(self, part: Slice, start: np.ndarray, end: np.ndarray, hashed: np.ndarray) -> None:
        size = end - start + 2  # with a marker on either side
        at = np.cumsum(size) - size
        text = np.zeros(int(size.sum()) + 8, np.uint8)
        inner = np.repeat(start - at - 1, size) + np.arange(int(size.sum()))
        np.take(part.bytes, inner, mode="clip", out=text[: len(inner)])
        text[at], text[at + size - 1] = 1, 2
        eight = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
        parts, owner = [hashed], [np.arange(len(hashed))]
        for n in GRAMS:
            many = np.maximum(size - n + 1, 0)
            who = np.repeat(np.arange(len(size)), many)
            place = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + at[who]
            parts.append(mixed((eight[place] & np.uint64((1 << 8 * n) - 1)) + np.uint64(n)))
            owner.append(who)
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        self.bucket = (np.concatenate(parts) % np.uint64(BUCKETS)).astype(np.int64)[order]
        self.bag = np.bincount(owner, minlength=len(size))  # n-grams of each distinct word
        self.bag_at = np.cumsum(self.bag) - self.bag

    def margins(self, weight: np.ndarray) -> np.ndarray:
        """Mean over each passage of the words' mean weights."""
        if not len(self.word):
            return np.zeros(0)
        by_word = np.add.reduceat(weight[self.bucket], self.bag_at) / self.bag
        sums = np.concatenate([[0], np.cumsum(by_word[self.word])])
        return (sums[self.stop] - sums[self.begin]) / (self.stop - self.begin)

    def worst(self, margins: np.ndarray) -> np.ndarray:
        """The passage with the largest margin of each document, -1 for none."""
        found = np.full(self.n, -1)
        order = np.lexsort((-np.arange(len(margins)), margins))
        found[self.doc[order]] = order
        return found


@dataclass(frozen=True)
class Toxicity:
    """weight of each bucket in the margin (log odds) of a passage, and the offset."""

    weight: np.ndarray | None = None
    offset: float = 0.0

    def __call__(self, part: Slice) -> np.ndarray:
        if self.weight is None:
            return np.zeros(part.n)
        bags = Bags(part)
        margins = bags.margins(self.weight)
        worst = bags.worst(margins)
        # A text without a word is as a passage of mean 0.
        most = np.where(worst >= 0, margins[worst] if len(margins) else 0.0, 0.0)
        return 1 / (1 + np.exp(-np.clip(most + self.offset, -40, 40)))


def lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def fit(rows: list[tuple[str, int]], rounds: int = 40, seed: int = 3) -> Toxicity:
    """Train on (text, 0/1) rows; without rows of both labels every score is 0."""
    y = np.array([label for _, label in rows], np.int64)
    if len(np.unique(y)) < 2:
        return Toxicity()
    bags = [Bags(part) for part in slices(lower(pa.array([t for t, _ in rows])), size=16 << 20)]
    ends = np.cumsum([b.n for b in bags])
    rng = np.random.default_rng(seed)
    # Start from how much likelier a document of either label holds the bucket.
    seen = np.zeros((2, BUCKETS))
    for b, end in zip(bags, ends, strict=True):
        which = np.repeat(b.doc, b.stop - b.begin)
        pairs = np.unique(which * (len(b.distinct) + 1) + b.word)
        docs, words = np.divmod(pairs, len(b.distinct) + 1)
        labels = y[end - b.n : end][docs]
        for label in (0, 1):
            held = np.bincount(words[labels == label], minlength=len(b.distinct))
            seen[label] += np.bincount(b.bucket, np.repeat(held, b.bag), BUCKETS)
    rate = seen / np.bincount(y, minlength=2)[:, None] + 4 / len(y)
    odds = np.log(rate[1]) - np.log(rate[0])
    classes = rng.normal(0, 1, (DIMENSIONS, 2))
    direction = classes[:, 1] - classes[:, 0]
    vectors = np.outer(odds, direction / (direction @ direction)) * 4
    vectors += rng.normal(0, 1e-3, vectors.shape)
    bias = np.zeros(2)
    sizes = [np.full(vectors.shape, 1e-6), np.full(classes.shape, 1e-6), np.full(2, 1e-6)]
    balance = len(y) / (2 * np.bincount(y, minlength=2))
    chosen: list[np.ndarray] = []
    for turn in range(rounds):
        weight = vectors @ (classes[:, 1] - classes[:, 0])
        if turn % 5 == 0:
            chosen = [b.worst(b.margins(weight)) for b in bags]
        for b, end, pick in zip(bags, ends, chosen, strict=True):
            docs = np.flatnonzero(pick >= 0)
            passage = pick[docs]
            length = (b.stop - b.begin)[passage]
            owner = np.repeat(np.arange(len(docs)), length)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + b.begin[passage][owner]
            word = b.word[place]
            bag = b.bag[word]
            gram_owner = np.repeat(np.arange(len(word)), bag)
            gram = b.bucket[np.arange(len(gram_owner)) - np.repeat(np.cumsum(bag) - bag, bag) + b.bag_at[word][gram_owner]]
            share = 1 / (bag * length[owner])
            rows_of, shares = owner[gram_owner], share[gram_owner]
            mean = np.stack([np.bincount(rows_of, vectors[gram, d] * shares, len(docs)) for d in range(DIMENSIONS)], axis=1)
            logits = mean @ classes + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            labels = y[end - b.n : end][docs]
            error = (p - np.eye(2)[labels]) * (balance[labels] / len(y))[:, None]
            back = error @ classes.T
            slopes = [
                np.stack([np.bincount(gram, back[rows_of, d] * shares, BUCKETS) for d in range(DIMENSIONS)], axis=1),
                mean.T @ error,
                error.sum(axis=0),
            ]
            for k, (value, slope, rate_) in enumerate(zip((vectors, classes, bias), slopes, (0.5, 0.05, 0.1), strict=True)):
                sizes[k] += slope**2
                value -= rate_ * slope / np.sqrt(sizes[k] + 1e-10)
    weight = vectors @ (classes[:, 1] - classes[:, 0])
    return Toxicity(weight.astype(np.float32), float(bias[1] - bias[0]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic: int = 1000,
    clean: int = 2000,
) -> Toxicity:
    """Fit on at most ``toxic`` documents labelled 1 and ``clean`` labelled 0 (whole texts)."""
    return fit(labelled_texts(docs, labels, label, {0: clean, 1: toxic}, id_col, text_col))


def score(docs: DataFrame, model: Toxicity, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``out`` in 0..1; null counts as the empty text."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats: half a megabyte

    def apply(column: pa.Array) -> pa.Array:
        found = [held.value(part) for part in slices(lower(column))]
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return docs.withColumn(out, F.arrow_udf(apply, "double")(F.col(text_col)))
