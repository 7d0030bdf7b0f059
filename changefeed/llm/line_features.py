"""Counts by line and by document that quality operators share."""

from __future__ import annotations

import numpy as np

from changefeed.llm.text import BLANKS, Slice, Windows, Words, code_points, mixed, per_doc, span_hashes, windows_of

_CLASSES = {
    "symbols": b"#*$%&|<>",
    "upper": bytes(range(0x41, 0x5B)),
    "lower": bytes(range(0x61, 0x7B)),
    "digits": bytes(range(0x30, 0x3A)),
    "bangs": b"!?",
    "stops": b".,;:",
}
_TABLES = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()}


class Lines:
    """Lines of a slice that hold a word, in order, with counts for each.

    ``repeated``: an earlier line of the same document is equal.
    """

    def __init__(self, part: Slice, words: Words):
        ends = np.flatnonzero(part.bytes == 0x0A)  # documents end by one, so no line spans two
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        first = np.searchsorted(words.start, starts)
        last = np.searchsorted(words.start, ends)
        full = last > first
        self.start, self.end = starts[full], ends[full]
        self.first_word, self.last_word = first[full], last[full]
        self.words = (last - first)[full]
        self.at = np.searchsorted(self.start, part.offsets)
        self.counts = np.diff(self.at)
        self.doc = np.repeat(np.arange(part.n), self.counts)
        hashed = span_hashes(part.bytes, self.start, self.end)
        order = np.lexsort((np.arange(len(hashed)), hashed, self.doc))
        same = np.zeros(len(hashed), bool)
        if len(order) > 1:
            a, b = order[:-1], order[1:]
            same[b] = (hashed[a] == hashed[b]) & (self.doc[a] == self.doc[b])
        self.repeated = same


def repeated_words(words: Words, hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """For each word: does it lie in a window of ``width`` words that its document holds twice or more?"""
    first, doc = windows_of(words, width)
    marks = np.zeros(len(hashes) + 1, np.int32)
    if len(first):
        value = Windows(hashes).of(first, first + width)
        value = value + mixed(doc.astype(np.uint64))  # one sort; documents stay apart
        order = np.argsort(value)
        a, b = order[:-1], order[1:]
        same = (value[a] == value[b]) & (doc[a] == doc[b])
        twice = np.zeros(len(first), bool)
        twice[a[same]] = True
        twice[b[same]] = True
        marks[first[twice]] += 1
        marks[first[twice] + width] -= 1
    return np.cumsum(marks[:-1]) > 0


def class_sums(part: Slice, start: np.ndarray, end: np.ndarray, names=tuple(_CLASSES)) -> dict[str, np.ndarray]:
    """How many bytes of each class lie in each range."""
    result = {}
    for name in names:
        sums = np.zeros(len(part.bytes) + 1, np.int64)
        np.cumsum(_TABLES[name][part.bytes], out=sums[1:])
        result[name] = sums[end] - sums[start]
    return result


class Document:
    """The base counts of each document of a slice."""

    def __init__(self, part: Slice):
        self.part = part
        self.words = words = Words(part, BLANKS)
        self.hashes = words.hashes()
        self.lines = Lines(part, words)
        points = code_points(part)
        self.lengths = points[words.end] - points[words.start]
        self.n_words = words.counts
        self.word_chars = per_doc(self.lengths, words.at)
        self.n_symbols = class_sums(part, part.offsets[:-1], part.offsets[1:], ("symbols",))["symbols"]
        self.n_dup_lines = per_doc(self.lines.repeated, self.lines.at)
        self.repeats = repeated_words(words, self.hashes)
        self.n_repeat_words = per_doc(self.repeats, words.at)
