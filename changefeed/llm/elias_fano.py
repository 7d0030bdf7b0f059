"""Elias-Fano sequences and a two-level n-gram trie over them, in memory-mapped files."""

from __future__ import annotations

import tempfile

import numpy as np

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_PLACE = np.zeros((256, 8), np.uint8)  # place of the k-th one in a byte
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _PLACE[_b, : len(_at)] = _at


def mapped(array: np.ndarray) -> np.ndarray:
    """The array in a file of its own that has no name and goes with its last reader."""
    if not array.size:
        return array
    with tempfile.TemporaryFile() as file:
        array.tofile(file)
        file.flush()
        return np.memmap(file, array.dtype, "r", shape=array.shape)


class EliasFano:
    """A non-decreasing sequence below ``universe`` in about 2 + log2(universe / n) bits a value.

    The low bits stand packed; the high parts are a bit vector with a one for
    each value after as many zeros as its high part says.
    """

    def __init__(self, values: np.ndarray, universe: int):
        values = values.astype(np.uint64)
        self.n = len(values)
        self.low = max(0, (max(1, universe) // max(1, self.n)).bit_length() - 1)
        self.shift = np.uint64(self.low)
        self.mask = np.uint64((1 << self.low) - 1)
        self.tops = int(universe >> self.low) + 1
        ones = (values >> self.shift).astype(np.int64) + np.arange(self.n)
        bits = np.zeros(-(-(self.n + self.tops + 1) // 8) * 8, np.uint8)
        bits[ones] = 1
        packed = np.packbits(bits, bitorder="little")
        count = _ONES[packed]
        self.upper = mapped(packed)
        # Ones before every 64th byte; between those, bytes are counted.
        self.before = mapped(np.concatenate([[0], np.cumsum(count, dtype=np.int64)]))
        self.lower = mapped(self._pack(values & self.mask))

    def _pack(self, low: np.ndarray) -> np.ndarray:
        """Each value's low bits after the other, in 64-bit words (one spare at the end)."""
        words = np.zeros(self.n * self.low // 64 + 2, np.uint64)
        at = np.arange(self.n, dtype=np.int64) * self.low
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, low << bit)
        over = np.flatnonzero((bit > 0) & (bit.astype(np.int64) + self.low > 64))
        np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - bit[over]))
        return words

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i * self.low
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        value = self.lower[word] >> bit
        next_ = np.where(bit > 0, self.lower[word + 1] << ((np.uint64(64) - bit) & np.uint64(63)), np.uint64(0))
        return (value | next_) & self.mask

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at places i: select the i-th one, then put high and low together."""
        i = np.asarray(i, np.int64)
        byte = np.searchsorted(self.before, i, "right") - 1
        place = byte * 8 + _PLACE[self.upper[byte], i - self.before[byte]]
        return ((place - i).astype(np.uint64) << self.shift) | self._low(i)

    def _rank(self, tops: np.ndarray) -> np.ndarray:
        """How many values have a high part below each of ``tops``: select the zero that ends it."""
        zero = np.maximum(tops - 1, 0)
        # Zeros before byte b are 8 b - before[b], a rising sequence too.
        low, high = np.zeros(len(tops), np.int64), np.full(len(tops), len(self.upper), np.int64)
        low = np.minimum(zero // 8, high - 1)  # at least: every byte holds 8 zeros at most
        span = 1
        high = low + 1
        while True:
            short = (high < len(self.upper)) & (8 * np.minimum(high, len(self.upper)) - self.before[np.minimum(high, len(self.upper))] <= zero)
            if not short.any():
                break
            low = np.where(short, high, low)
            high = np.where(short, np.minimum(high + span, len(self.upper)), high)
            span *= 2
        while True:
            todo = np.flatnonzero(high - low > 1)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) >> 1
            up = 8 * middle - self.before[middle] <= zero[todo]
            low[todo[up]] = middle[up]
            high[todo[~up]] = middle[~up]
        inside = zero - (8 * low - self.before[low])
        place = low * 8 + _PLACE[self.upper[low] ^ 255, inside]
        return np.where(tops > 0, place - zero, 0)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where the sequence lacks it (first of equals)."""
        found = np.full(len(values), -1)
        if not self.n:
            return found
        values = values.astype(np.uint64)
        top = (values >> self.shift).astype(np.int64)
        todo = np.flatnonzero(top < self.tops)
        at, stop = self._rank(top[todo]), self._rank(top[todo] + 1)
        # Values with one high part are in order of their low bits: bisection.
        low, end = (values & self.mask)[todo], stop.copy()
        open_ = np.flatnonzero(at < end)
        while len(open_):
            middle = (at[open_] + end[open_]) >> 1
            up = self._low(middle) < low[open_]
            at[open_[up]] = middle[up] + 1
            end[open_[~up]] = middle[~up]
            open_ = open_[at[open_] < end[open_]]
        inside = np.flatnonzero(at < stop)
        hit = inside[self._low(at[inside]) == low[inside]]
        found[todo[hit]] = at[hit]
        return found


STEP = 0.03  # log10 between two codes
NONE = 0


def coded(p: np.ndarray) -> np.ndarray:
    """Probabilities in (0, 1] as codes 1..255 of their logarithms; 0 stays 0."""
    with np.errstate(divide="ignore"):
        code = 1 + np.rint(-np.log10(p) / STEP)
    return np.where(p > 0, np.clip(code, 1, 255), NONE).astype(np.uint8)


DECODED = np.concatenate([[0.0], 10.0 ** (-STEP * np.arange(255))])


class Trie:
    """Words, and after each the words that followed it, with counts turned into codes.

    Level 1: word hashes (Elias-Fano), their counts, a code for the weight of
    the lower order after each, and pointers (Elias-Fano) to level 2. Level 2:
    the followers' hashes, made monotone by the place of the context, and a
    code for each discounted probability. A lookup goes from the context to
    its range and searches the follower there.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, context: np.ndarray, follower: np.ndarray, pairs: np.ndarray, bits: int, discount: float):
        self.bits = np.uint64(bits)
        self.words = EliasFano(words, 1 << 64)
        self.counts = mapped(counts)
        many = np.bincount(context, minlength=len(words))
        total = np.bincount(context, pairs, len(words))
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.where(total > 0, discount * many / total, 0.0)
            share = (pairs - discount) / total[context]
        self.rest = mapped(coded(rest))
        self.codes = mapped(coded(share))
        self.pointers = EliasFano(np.concatenate([[0], np.cumsum(many)]), len(pairs) + 1)
        self.followers = EliasFano((context.astype(np.uint64) << self.bits) | follower, max(1, len(words)) << bits)

    def look_up(self, words: np.ndarray, owner: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts and rest codes of words, and codes of the followers of words[owner]."""
        at = self.words.find(words)
        known = at >= 0
        counts = np.where(known, self.counts[at] if len(self.counts) else 0, 0)
        rest = np.where(known, self.rest[at] if len(self.rest) else 0, NONE).astype(np.uint8)
        codes = np.zeros(len(owner), np.uint8)
        ask = np.flatnonzero(known[owner] & (rest[owner] != NONE))
        context = at[owner[ask]]
        place = self.followers.find((context.astype(np.uint64) << self.bits) | follower[ask])
        found = place >= 0
        begin, end = self.pointers[context[found]], self.pointers[context[found] + 1]
        place = place[found].astype(np.uint64)
        inside = (place >= begin) & (place < end)
        codes[ask[found][inside]] = self.codes[place[inside].astype(np.int64)]
        return counts, rest, codes
