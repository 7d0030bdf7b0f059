"""Numpy arrays as binary columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Values as bytes, cut at the places ``at``."""
    size = values.dtype.itemsize
    offsets = pa.py_buffer((at * size).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def flat(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of all binary rows after each other, and how many each has."""
    chunks, counts = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if not len(chunk):
            continue
        chunk = chunk.cast(pa.large_binary())
        _, places, data = chunk.buffers()
        at = np.frombuffer(places, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        # A copy: slices of a buffer need not be aligned.
        chunks.append(np.frombuffer(bytes(memoryview(data or b"")[at[0] : at[-1]]), kind))
        counts.append(np.diff(at) // np.dtype(kind).itemsize)
    return np.concatenate(chunks), np.concatenate(counts)


def planes(values: np.ndarray, size: int) -> bytes:
    """The lowest ``size`` bytes of each value, all first bytes first: small numbers compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def unplanes(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.view("<u8").ravel()


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes as the largest needs, compressed; the first 9 bytes tell that size and the count."""
    size = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    head = bytes([size]) + len(values).to_bytes(8, "little")
    return head + (pa.compress(planes(values, size), codec="zstd", asbytes=True) if len(values) else b"")


def unpacked(data: bytes) -> np.ndarray:
    size, count = data[0], int.from_bytes(data[1:9], "little")
    if not count:
        return np.zeros(0, np.int64)
    return unplanes(pa.decompress(data[9:], size * count, codec="zstd"), size).astype(np.int64)
