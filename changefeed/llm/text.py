"""Words, lines and window hashes of whole Arrow string batches, in numpy.

Everything works on UTF-8 bytes: the word rules of the operators separate on
ASCII characters only, which never occur inside a longer UTF-8 sequence. A
batch is cut between documents into slices of bounded size, so that the
temporary arrays stay small whatever the batch; a longer document is a slice
of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: True for the bytes between words of `[^\x20\x09-\x0D]+`.
BLANKS = _SPACE
#: True for the bytes between words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

_EMPTY, _NEWLINE = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_ODD = 0x9E3779B97F4A7C15
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def lowered(data: bytes) -> bytes:
    """A-Z to a-z, all other bytes unchanged."""
    return data.translate(_LOWER)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    return x ^ (x >> np.uint64(33))


class Slice:
    """Some documents of a batch: their bytes, each document ended by a newline."""

    def __init__(self, data: bytes, offsets: np.ndarray, first: int):
        self.data = data
        self.bytes = np.frombuffer(data, np.uint8)
        self.offsets = offsets  # of each document, and the end
        self.first = first  # row number of the first document in its batch
        self.n = len(offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1] - 1]


def slices(column: pa.Array | pa.ChunkedArray, lower: bool = False, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The documents of a string column in order; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pc.binary_join_element_wise(column, _EMPTY, _NEWLINE)
    _, places, buffer = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    view, row = memoryview(buffer), 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), len(column))
        data = bytes(view[offsets[row] : offsets[end]])
        yield Slice(lowered(data) if lower else data, offsets[row : end + 1] - offsets[row], row)
        row = end
    release()


def release() -> None:
    """Give free memory back to the system: workers go on with other operators, whose peaks would add to it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Words:
    """Words of a slice in order: start, end (bytes), and ``at``: where each document's begin."""

    def __init__(self, part: Slice, between: np.ndarray = BLANKS):
        inside = np.zeros(len(part.bytes) + 1, bool)
        np.logical_not(between[part.bytes], out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.part, self.start, self.end = part, edges[0::2], edges[1::2]
        self.at = np.searchsorted(self.start, part.offsets)
        self.counts = np.diff(self.at)

    @property
    def doc(self) -> np.ndarray:
        """The document's place in the slice, for each word."""
        return np.repeat(np.arange(self.part.n), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.part.bytes, self.start, self.end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    left = end - start
    hashed = mixed(left.astype(np.uint64) + np.uint64(_ODD))
    at, todo = start.copy(), np.flatnonzero(left > 0)
    while len(todo):
        some = left[todo]
        block = eight[at[todo]] & _MASKS[np.minimum(some, 8)]
        hashed[todo] = mixed(hashed[todo] ^ block) + np.uint64(_ODD)
        at[todo] += 8
        left[todo] -= 8
        todo = todo[some > 8]
    return hashed


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


class Windows:
    """Hashes of any run of words, from running sums over the words' hashes."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = _powers(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of words start..end (exclusive); equal runs of words give equal values."""
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return mixed(value + (end - start).astype(np.uint64) * _M2)


def windows_of(words: Words, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First word and document of every window; short: a document of fewer words is one window."""
    n = words.counts
    many = np.maximum(n - width + 1, 0)
    if short:
        many = np.where((n > 0) & (n < width), 1, many)
    doc = np.repeat(np.arange(words.part.n), many)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + words.at[:-1][doc]
    return first, doc


def code_points(part: Slice) -> np.ndarray:
    """How many code points begin before each byte (one more entry than bytes)."""
    before = np.zeros(len(part.bytes) + 1, np.int64)
    np.cumsum((part.bytes & 0xC0) != 0x80, out=before[1:])
    return before


def per_doc(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive places ``at``; empty ranges give 0."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]
