"""Words and shingles of Arrow text columns as numpy arrays.

Every function works on UTF-8 bytes: the word classes used here are defined on
ASCII characters only, so bytes of longer characters simply count as word bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1


class Words(NamedTuple):
    """Words of several texts: byte ranges, 64-bit hashes, and the first word of every text."""

    data: np.ndarray  # bytes after lower-casing
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # length: texts + 1


def byte_class(member) -> np.ndarray:
    """A table of 256 booleans; bytes from 128 on always belong to a word."""
    return np.array([b >= 128 or bool(member(chr(b))) for b in range(256)])


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
NOT_SPACE = byte_class(lambda c: c not in " \t\n\v\f\r")
LETTER_DIGIT = byte_class(lambda c: c.isalnum())


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    size, step = 1, base
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(step)
        size, step = size + more, step * step & _M64
    return out


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy row ranges with about `limit` bytes of text; one longer text is a range of its own."""
    ends = _offsets(batch.column(text))[1:]
    row = 0
    while row < batch.num_rows:
        before = ends[row - 1] if row else _offsets(batch.column(text))[0]
        stop = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(row, stop - row)
        row = stop


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column without nulls, and where each text begins (and the last ends)."""
    at = _offsets(column) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def words(column: pa.Array, kind: np.ndarray) -> Words:
    """Lower-case A-Z and take maximal runs of bytes of `kind` within each text."""
    data, at = text_bytes(column)
    data = LOWER[data]
    inside = kind[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[at[1:-1][(at[1:-1] > 0)] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, range_hash(data, start, end), np.searchsorted(start, at))


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte range, from one running sum over all bytes.

    The sum is kept modulo 2^64 with the first byte of a range weighted highest, so
    equal ranges hash alike wherever they stand.
    """
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n), out=total[1:])
    back = powers(n + 1, pow(_BASE, -1, 1 << 64))
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


def shingle_hash(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of `size` word hashes (across texts; the caller drops those)."""
    n = len(w) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    weight = _BASE
    for k in range(size):
        out += w[k : k + n] * np.uint64(weight)
        weight = weight * 0xD1342543DE82EF95 & _M64
    return mix(out)


def text_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which a run of `size` words of one text begins, and the text of each."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    begin = np.cumsum(count) - count
    return np.arange(len(text)) - begin[text] + first[:-1][text], text
