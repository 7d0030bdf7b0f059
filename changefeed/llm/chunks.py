"""Distinct chunks of the texts of a slice, found by Arrow's dictionary encoding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from changefeed.llm.text import Slice


def chunks(part: Slice, new: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Number of the distinct chunk for each chunk, the distinct ones, and where each document's chunks begin.

    ``new`` marks the bytes at which a chunk begins; a document begins one
    anyway. The newline that ends a document belongs to no chunk.
    """
    new = new.copy()
    ends = part.offsets[1:] - 1
    new[part.offsets[:-1]] = True
    new[ends] = True
    start = np.flatnonzero(new)
    places = np.append(start, len(part.bytes)).astype(np.int64)
    spans = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(part.data)])
    coded = spans.dictionary_encode()
    inside = np.ones(len(start), bool)
    inside[np.searchsorted(start, ends)] = False
    at = np.searchsorted(start, part.offsets) - np.arange(part.n + 1)
    return coded.indices.to_numpy()[inside], coded.dictionary.to_pylist(), at


class Numbers:
    """Numbers of chunks in the order in which they were first seen; cleared by ``limit`` distinct ones or bytes of them."""

    def __init__(self, limit: int, size: int):
        self.limit, self.size = limit, size
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.bytes = 0

    @property
    def full(self) -> bool:
        return len(self.numbers) > self.limit or self.bytes > self.size

    def of(self, found: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The number of each chunk, and the chunks that are new, in the order of their numbers."""
        numbers = self.numbers
        fresh = [c for c in found if c not in numbers]
        for chunk in fresh:
            numbers[chunk] = len(numbers)
            self.bytes += len(chunk)
        return np.fromiter((numbers[c] for c in found), np.int64, len(found)), fresh


def ranges(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places at..at+size of all ranges, after each other."""
    begin = np.cumsum(size) - size
    return np.repeat(at - begin, size) + np.arange(int(size.sum()))
