"""Line labels by a linear-chain conditional random field; content share decides.

Every line with a word gets a state, boilerplate (0) or content (1). A line's
features are shares in 0..1 read from its characters; weights for features and
for transitions are fitted by maximum likelihood (forward-backward) on lines
that plain rules mark in a bounded sample of documents. Viterbi decoding then
labels all lines of a document together, so that a line is judged with its
neighbours. A document is kept if at least ``min_share`` of its words stand in
content lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.line_features import Document, class_sums
from changefeed.llm.sampling import bounded
from changefeed.llm.text import per_doc, slices

STATES = 2
FEATURES = (
    "bias",
    "symbols_by_word",
    "upper_share",
    "bangs_by_word",
    "digit_share",
    "repeated_line",
    "repeated_words",
    "short",
    "ends_with_stop",
    "long_words",
)


def line_features(document: Document) -> np.ndarray:
    """One row per line, in the order of FEATURES, values in 0..1."""
    lines, part = document.lines, document.part
    sums = class_sums(part, lines.start, lines.end)
    words = np.maximum(lines.words, 1)
    marks = np.concatenate([[0], np.cumsum(document.repeats)])
    letters = np.concatenate([[0], np.cumsum(document.lengths)])
    chars = (letters[lines.last_word] - letters[lines.first_word]).astype(float)
    last = document.words.end[lines.last_word - 1] - 1 if len(words) else np.zeros(0, int)
    stops = np.isin(part.bytes[last], list(b".!?:;\"')"))
    cased = sums["upper"] + sums["lower"]
    return np.stack(
        [
            np.ones(len(words)),
            np.minimum(1, sums["symbols"] / words),
            sums["upper"] / np.maximum(cased, 1),
            np.minimum(1, sums["bangs"] / words),
            sums["digits"] / np.maximum(chars, 1),
            lines.repeated.astype(float),
            (marks[lines.last_word] - marks[lines.first_word]) / words,
            (lines.words < 3).astype(float),
            stops.astype(float),
            np.minimum(1, chars / words / 20),
        ],
        axis=1,
    )


def rule_labels(x: np.ndarray) -> np.ndarray:
    """The labels to fit: boilerplate where one signal is plain, content elsewhere."""
    f = {name: x[:, k] for k, name in enumerate(FEATURES)}
    plain = (
        (f["symbols_by_word"] >= 0.3)
        | (f["bangs_by_word"] >= 0.3)
        | ((f["upper_share"] >= 0.6) & (f["short"] == 0))
        | (f["digit_share"] >= 0.5)
        | (f["repeated_line"] > 0)
        | (f["repeated_words"] >= 0.5)
    )
    return (~plain).astype(np.int64)


@dataclass(frozen=True)
class LineModel:
    """weights: feature x state; transitions: from x to; start: state."""

    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray


def _steps(counts: np.ndarray, at: np.ndarray):
    """Places of the t-th line of every sequence that long, and those sequences, for each t."""
    order = np.argsort(-counts, kind="stable")
    for t in range(int(counts.max(initial=0))):
        live = order[: np.searchsorted(-counts[order], -t, "left")]
        yield at[live] + t, live


def viterbi(model: LineModel, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The likeliest states of every sequence; ties take content."""
    at = np.cumsum(counts) - counts
    scores = x @ model.weights
    best, back = np.zeros((len(counts), STATES)), np.zeros((len(x), STATES), np.int8)
    trail = []
    for t, (rows, live) in enumerate(_steps(counts, at)):
        if t == 0:
            best[live] = model.start + scores[rows]
        else:
            paths = best[live][:, :, None] + model.transitions  # sequence, from, to
            pick = (paths[:, 1] >= paths[:, 0]).astype(np.int8)
            back[rows] = pick
            best[live] = np.maximum(paths[:, 0], paths[:, 1]) + scores[rows]
        trail.append((rows, live))
    states, now = np.zeros(len(x), np.int8), (best[:, 1] >= best[:, 0]).astype(np.int8)
    for rows, live in reversed(trail):
        states[rows] = now[live]
        now[live] = back[rows, now[live]]
    return states


def marginals(model: LineModel, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward: P(state) by line, expected transitions, expected starts."""
    at = np.cumsum(counts) - counts
    local = np.exp(np.clip(x @ model.weights, -30, 30))
    moves = np.exp(model.transitions)
    forward, backward = np.zeros((len(x), STATES)), np.ones((len(x), STATES))
    trail = list(_steps(counts, at))
    for t, (rows, _) in enumerate(trail):
        f = np.exp(model.start) * local[rows] if t == 0 else (forward[rows - 1] @ moves) * local[rows]
        forward[rows] = f / f.sum(axis=1, keepdims=True)
    expected = np.zeros((STATES, STATES))
    for rows, _ in reversed(trail[1:]):
        ahead = local[rows] * backward[rows]
        b = ahead @ moves.T
        backward[rows - 1] = b / b.sum(axis=1, keepdims=True)
        pairs = forward[rows - 1][:, :, None] * moves * ahead[:, None, :]
        expected += (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    state = forward * backward
    state /= state.sum(axis=1, keepdims=True)
    firsts = at[counts > 0]
    return state, expected, state[firsts].sum(axis=0)


def fit_lines(x: np.ndarray, labels: np.ndarray, counts: np.ndarray, rounds: int = 60, l2: float = 1e-3) -> LineModel:
    """Maximum likelihood by adaptive gradient steps; without lines every weight is 0."""
    weights, moves, start = np.zeros((x.shape[1], STATES)), np.zeros((STATES, STATES)), np.zeros(STATES)
    if not len(x):
        return LineModel(weights, moves, start)
    at = np.cumsum(counts) - counts
    one_hot = np.eye(STATES)[labels]
    inner = np.ones(len(x), bool)
    inner[at[counts > 0]] = False
    seen = np.zeros((STATES, STATES))
    rows = np.flatnonzero(inner)
    np.add.at(seen, (labels[rows - 1], labels[rows]), 1)
    first = one_hot[at[counts > 0]].sum(axis=0)
    sizes = [np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(start)]
    for _ in range(rounds):
        state, expected, begun = marginals(LineModel(weights, moves, start), x, counts)
        slopes = [x.T @ (one_hot - state), seen - expected, first - begun]
        for k, (value, slope) in enumerate(zip((weights, moves, start), slopes, strict=True)):
            slope = slope / len(x) - l2 * value
            sizes[k] += slope**2
            value += 0.8 * slope / np.sqrt(sizes[k] + 1e-12)
    return LineModel(weights, moves, start)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 1500) -> LineModel:
    """Fit on at most ``sample`` documents (whole texts), chosen by a hash of their id."""
    rows = bounded(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", sample).collect()
    found, counts = [], []
    for part in slices(pa.array([r["_text"] for r in rows], pa.string())):
        document = Document(part)
        found.append(line_features(document))
        counts.append(document.lines.counts)
    x = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
    return fit_lines(x, rule_labels(x), np.concatenate(counts) if counts else np.zeros(0, int))


_RESULT = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("content_share", pa.float64()), ("kept", pa.bool_())]
    + [("line_states", pa.string())]
)


def _judge(column: pa.Array, model: LineModel, min_share: float) -> pa.Array:
    out = []
    for part in slices(column):
        d = Document(part)
        states = viterbi(model, line_features(d), d.lines.counts)
        content = per_doc(np.where(states == 1, d.lines.words, 0), d.lines.at)
        share = content / np.maximum(d.n_words, 1)
        failed = (d.n_words < 10) | (100 * d.n_repeat_words > 20 * d.n_words)
        marks = np.where(states == 1, ord("C"), ord("B")).astype(np.uint8).tobytes().decode()
        labels = [marks[a:b] for a, b in zip(d.lines.at[:-1], d.lines.at[1:], strict=True)]
        values = [d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words]
        arrays = [pa.array(v.astype(np.int64)) for v in values]
        arrays += [pa.array(failed), pa.array(share), pa.array(~failed & (share >= min_share)), pa.array(labels, pa.string())]
        out.append(pa.StructArray.from_arrays(arrays, fields=list(_RESULT)))
    return pa.concat_arrays(out) if out else pa.array([], _RESULT)


def judge(
    docs: DataFrame, model: LineModel, text_col: str = "text", out: str = "quality", min_share: float = 0.5
) -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: base counts, base_failed, content_share, kept, line_states.

    ``line_states`` has a letter (C content, B boilerplate) for each line that
    holds a word. Null and empty texts have no words: base_failed, not kept,
    share 0. Rows are judged one by one, so repeated rows and ids change nothing.
    """
    kinds = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean, line_states string"
    mark = F.arrow_udf(lambda column: _judge(column, model, min_share), kinds)
    return docs.withColumn(out, mark(F.col(text_col)))
