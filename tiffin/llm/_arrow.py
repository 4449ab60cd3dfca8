"""Numpy views of Arrow text columns and vectorised word hashing, used inside mapInArrow tasks."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; keeps numpy temporaries near the CPU caches and bounds memory.
SLICE = 1 << 17

# Workers go on to other tasks, so large buffers are to go back to the system when they are freed: they are mapped one by
# one (mallopt's threshold for that, -3, else grows), by the system's allocator.
pa.set_memory_pool(pa.system_memory_pool())
try:
    ctypes.CDLL(None).mallopt(-3, 2 << 20)
except (OSError, AttributeError):  # another C library
    pass

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.default_rng(20240608).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(separators) -> np.ndarray:
    """True for the bytes that belong to words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


SPACES = byte_class([0x20, *range(0x09, 0x0E)])
ALNUM = byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _P, np.uint64), np.full(n, _P_INV, np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(max(1 << 18, 1 << max(n, 1).bit_length()))
    return up[:n], down[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (rows + 1) and the UTF-8 bytes of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return o, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, limit: int = SLICE):
    """Runs of rows [i, j) with at most `limit` bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def texts(column: pa.Array):
    """The texts of a column (None for null), made a few at a time: a batch can hold many long ones."""
    for i, j in slices(text_bytes(column)[0]):
        yield from column.slice(i, j - i).to_pylist()


class Words:
    """The words of some rows: byte spans in `buf`, hashes, and where each row's words begin. A-Z are lower-cased if asked."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, word_bytes: np.ndarray, lower: bool = True):
        rel = offsets - offsets[0]
        low = data[offsets[0] : offsets[-1]]
        low = LOWER[low] if lower else low
        self.buf = buf = np.insert(low, rel[1:], 0x20)
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[1:] = word_bytes[buf]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, rel + np.arange(len(rel)))
        up, down = powers(len(buf))
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def text(self, i: int, j: int) -> bytes:
        """Words i to j, one space between them."""
        return b" ".join(self.buf[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j]))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of `width` consecutive words; of a shorter sequence, one hash of all of it."""
    n = len(words)
    if n == 0:
        return words
    span = min(width, n)
    out = np.zeros(n - span + 1, np.uint64)
    for k in range(span):
        out += words[k : n - span + 1 + k] * _STEP[k]
    return mix(out + np.uint64(span))
