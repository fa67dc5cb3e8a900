"""Numpy views of Arrow text batches: slices, words and word hashes.

Texts arrive as Arrow binary columns (UTF-8). White space is
``[\\x20\\x09-\\x0D]`` everywhere; those bytes never occur inside a multi-byte
UTF-8 character, so words are found on bytes. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

WHITE = b" \t\n\x0b\x0c\r"
IS_WHITE = np.zeros(256, bool)
IS_WHITE[list(WHITE)] = True
#: Byte-wise lower-casing of A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text handled by one numpy step (a longer single text is one step).
STEP_BYTES = 1 << 20
#: Bytes whose words are hashed together (a longer single word is hashed by itself).
HASH_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply): every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64."""
    tables = np.empty((2, n), np.uint64)
    tables[0], tables[1] = _BASE, pow(_BASE, -1, 1 << 64)
    tables[:, 0] = 1
    np.multiply.accumulate(tables, axis=1, out=tables)
    return tables[0], tables[1]


@cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(HASH_BYTES + 1)


def views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a binary or string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data, offsets


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past-last row, bytes, offsets from 0) with at most ``limit`` bytes or one row."""
    data, offsets = views(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row number of every word; a word never crosses rows."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    solid = ~IS_WHITE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True                     # a row begins here
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes, whatever stands around it."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + HASH_BYTES, "right")))
        out[at:to] = _hashed(data[base: ends[to - 1]], starts[at:to] - base, ends[at:to] - base)
        at = to
    return out


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes from one running polynomial sum over the bytes."""
    up, down = _usual_powers() if len(data) <= HASH_BYTES else _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def count_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words per row."""
    _, _, row = word_spans(data, offsets)
    return np.bincount(row, minlength=len(offsets) - 1).astype(np.int64)
