"""Document scores learnt from preference pairs (Bradley-Terry).

A document labelled 1 is preferred over one labelled 0. The score is linear
in features of the text, and P(i over j) = sigmoid(s_i - s_j): weights come
from logistic loss over all pairs of the labelled documents, which are counted
by bins of their scores. The cut is a quantile of all their scores, the one
that parts the labels best, and the reported value maps it to 0.7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.components import discarded, saved
from changefeed.llm.line_features import Document, class_sums
from changefeed.llm.text import per_doc, slices

CUT = 0.7  # the value reported at the learnt quantile
WIDTH = 15  # features
BINS, BINS_PER_UNIT = 512, 8  # of scores, for sums over pairs
GRID = 1 << 16  # steps of scores, for the cut
_UPPER = np.triu_indices(WIDTH)


def features(part) -> np.ndarray:
    """One row per document; an empty text has zeros."""
    d = Document(part)
    words, lines = np.maximum(d.n_words, 1), np.maximum(d.lines.counts, 1)
    chars = np.maximum(d.word_chars, 1)
    sums = class_sums(part, part.offsets[:-1], part.offsets[1:])
    distinct = np.zeros(part.n)
    doc = d.words.doc
    if len(doc):
        keys = np.unique(np.stack([doc.astype(np.uint64), d.hashes]), axis=1) if len(doc) < 64 else None
        if keys is None:
            order = np.lexsort((d.hashes, doc))
            new = np.ones(len(doc), bool)
            new[1:] = (d.hashes[order][1:] != d.hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
            distinct = np.bincount(doc[order][new], minlength=part.n).astype(float)
        else:
            distinct = np.bincount(keys[0].astype(int), minlength=part.n).astype(float)
    cased = np.maximum(sums["upper"] + sums["lower"], 1)
    short = per_doc((d.lines.words < 3).astype(np.int64), d.lines.at)
    return np.stack(
        [
            np.minimum(2, sums["symbols"] / words),
            np.minimum(1, 10 * sums["symbols"] / words),
            sums["upper"] / cased,
            (sums["upper"] / cased > 0.3).astype(float),
            np.minimum(2, sums["bangs"] / words),
            sums["digits"] / chars,
            np.minimum(1, sums["stops"] / words),
            d.n_repeat_words / words,
            d.n_dup_lines / lines,
            distinct / words,
            short / lines,
            np.minimum(20, chars / words) / 20,
            np.log1p(d.n_words) / 10,
            np.log1p(d.n_words / lines) / 10,
            (d.n_words < 10).astype(float),
        ],
        axis=1,
    )


@dataclass(frozen=True)
class Ranking:
    """value = sigmoid(scale * (weights . (x - mean) / spread - cut) + logit(CUT)); no weights: 0.5."""

    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    cut: float = 0.0
    scale: float = 1.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        raw = ((x - self.mean) / self.spread) @ self.weights
        shifted = self.scale * (raw - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shifted, -40, 40)))


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str) -> DataFrame:
    """(y, x): label and features of every labelled document, written once; texts are not moved.

    Documents with several labels have the largest; rows that share an id all count.
    """
    one = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    one = one.groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("y")).where(F.col("y").isin(0, 1))

    def apply(column: pa.Array) -> pa.Array:
        found = [features(part) for part in slices(column)]
        x = np.concatenate(found) if found else np.zeros((0, WIDTH))
        return pa.ListArray.from_arrays(np.arange(0, x.size + 1, WIDTH, dtype=np.int32), x.ravel())

    found = docs.dropna(subset=[id_col]).select(F.col(id_col).alias("_id"), F.arrow_udf(apply, "array<double>")(F.col(text_col)).alias("x"))
    return saved(found.join(one, "_id").select(F.col("y").cast("int").alias("y"), "x"), "quality-features")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, WIDTH)


def _bin_sums(table: DataFrame, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray) -> dict[int, np.ndarray]:
    """Per label, a row for each bin of scores under ``weights``: count, sums of z, sums of its products.

    A task sends one row for each label and bin, so the rows do not grow with the documents.
    """
    names = [f"s{k}" for k in range(1 + WIDTH + len(_UPPER[0]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2 * BINS, len(names)))
        for batch in batches:
            if not batch.num_rows:
                continue
            z = (_matrix(batch.column("x")) - mean) / spread
            bins = np.clip(np.floor((z @ weights) * BINS_PER_UNIT) + BINS // 2, 0, BINS - 1).astype(int)
            key = np.asarray(batch.column("y")) * BINS + bins
            order = np.argsort(key, kind="stable")
            key, z = key[order], z[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            rows = np.concatenate([np.ones((len(z), 1)), z, z[:, _UPPER[0]] * z[:, _UPPER[1]]], axis=1)
            sums[key[first]] += np.add.reduceat(rows, first, axis=0)
        held = np.flatnonzero(sums[:, 0])
        columns = [pa.array(held, pa.int64()), *[pa.array(c) for c in sums[held].T]]
        yield pa.RecordBatch.from_arrays(columns, ["key", *names])

    schema = "key bigint, " + ", ".join(f"{n} double" for n in names)
    found = table.mapInArrow(run, schema).groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).toArrow().sort_by("key")
    key, rows = np.asarray(found["key"]), np.stack([np.asarray(found[n]) for n in names], axis=1)
    return {y: rows[key // BINS == y] for y in (0, 1)}


def _squares(rows: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Sums of products, each bin's weighted by ``by``, as a symmetric matrix."""
    out = np.zeros((WIDTH, WIDTH))
    out[_UPPER] = by @ rows[:, 1 + WIDTH :]
    return out + np.triu(out, 1).T


def _pair_loss(sums: dict[int, np.ndarray], weights: np.ndarray, l2: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logistic loss over all pairs of a good and a bad document, slope and curvature.

    Documents of a bin stand at the bin's mean score, a 1/16 off at most.
    """
    good, bad = sums[1], sums[0]
    (n, xg), (m, xb) = ((part[:, 0], part[:, 1 : 1 + WIDTH]) for part in (good, bad))
    gap = ((xg @ weights) / n)[:, None] - ((xb @ weights) / m)[None, :]
    miss, total = 1 / (1 + np.exp(np.clip(gap, -40, 40))), n.sum() * m.sum()
    curve = miss * (1 - miss)
    loss = (n @ np.logaddexp(0, -gap) @ m) / total + l2 / 2 * weights @ weights
    slope = ((n @ miss) @ xb - (miss @ m) @ xg) / total + l2 * weights
    cross = xg.T @ curve @ xb
    return loss, slope, (_squares(good, curve @ m) + _squares(bad, n @ curve) - cross - cross.T) / total + l2 * np.eye(WIDTH)


def fit(table: DataFrame, rounds: int = 30, l2: float = 1e-3) -> Ranking:
    """Learn from all pairs of the rows of ``table`` (y, x); one label alone gives no ranking.

    Newton's method: each round is one pass over the rows, which are summed by
    label and bin of their score. All figures come from every row.
    """
    at = [F.col("x")[k] for k in range(WIDTH)]
    held = table.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0), *map(F.avg, at), *map(F.stddev_pop, at)).first()
    if not held[0] or not held[1]:
        return Ranking()
    # Rounded here and below, so that the order of sums does not show.
    mean, spread = (np.round(np.array(held[2 + k * WIDTH :][:WIDTH], float), 10) for k in (0, 1))
    spread = spread + 1e-6
    weights, step, least = np.zeros(WIDTH), np.zeros(WIDTH), np.inf
    for _ in range(rounds):
        loss, slope, curvature = _pair_loss(_bin_sums(table, mean, spread, weights + step), weights + step, l2)
        if loss > least + 1e-9:
            step = step / 2
        else:
            weights, least = weights + step, loss
            step = -np.linalg.solve(curvature, slope)
        # What is left to gain is too small to move a score.
        if np.abs(step).max() < 1e-4 or abs(slope @ step) < 1e-7:
            break
    weights = np.round(weights, 6)
    return Ranking(weights, mean, spread, *_cut(table, mean, spread, weights))


def _cut(table: DataFrame, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """The quantile of all scores that parts the labels with fewest mean errors, and the scale.

    Scores are counted on a grid of ``GRID`` steps from the least to the greatest.
    """

    def apply(x: pa.Array) -> pa.Array:
        return pa.array(((_matrix(x) - mean) / spread) @ weights)

    scores = table.select("y", F.arrow_udf(apply, "double")("x").alias("raw"))
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    place = F.least(F.floor((F.col("raw") - low) * (GRID / max(high - low, 1e-9))), F.lit(GRID - 1))
    counts = [F.count_if(F.col("y") == y).alias(f"n{y}") for y in (0, 1)]
    found = scores.groupBy(place.alias("place")).agg(*counts, F.min("raw").alias("low"), F.max("raw").alias("high")).toArrow().sort_by("place")
    bad, good, lows, highs = (np.asarray(found[c]) for c in ("n0", "n1", "low", "high"))
    upto = np.cumsum(good + bad)
    # Between two neighbours in different steps quantiles lie in the gap; within a step, at its least score.
    rank = np.linspace(0.005, 0.995, 199) * (upto[-1] - 1)
    under, share = np.floor(rank), rank % 1
    left, right = np.searchsorted(upto, under, side="right"), np.searchsorted(upto, np.minimum(under + 1, upto[-1] - 1), side="right")
    inside = (left == right) | (share == 0)
    at = np.where(inside, left, right)
    cuts, first = np.unique(np.where(inside, lows[left], highs[left] + share * (lows[right] - highs[left])), return_index=True)
    at = at[first]
    before = [np.r_[0, np.cumsum(c)] for c in (good, bad)]
    errors = before[0][at] / good.sum() + 1 - before[1][at] / bad.sum()
    best = np.flatnonzero(np.isclose(errors, errors.min()))
    cut = cuts[best[len(best) // 2]]
    if len(best) == 1 and at[best[0]] > 0:
        cut = (highs[at[best[0]] - 1] + lows[at[best[0]]]) / 2
    middle = [(lows + highs)[np.searchsorted(np.cumsum(c), c.sum() / 2)] / 2 for c in (good, bad)]
    return float(cut), float(4 / max(1e-6, middle[0] - middle[1]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Ranking:
    """Fit on all labelled documents (whole texts)."""
    table = labelled_features(docs, labels, label, id_col, text_col)
    ranking = fit(table)
    discarded(table)
    return ranking


def score(docs: DataFrame, ranking: Ranking, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``out`` in 0..1; null counts as the empty text."""

    def apply(column: pa.Array) -> pa.Array:
        found = [ranking(features(part)) for part in slices(column)]
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return docs.withColumn(out, F.arrow_udf(apply, "double")(F.col(text_col)))
