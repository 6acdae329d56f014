"""Words, hashes and windows of whole Arrow text columns, computed with numpy inside Spark tasks.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``; since
those separators are ASCII, working on UTF-8 bytes equals working on code
points. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SLICE_BYTES = 2 << 20
_HASH_BYTES = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def multipliers(n: int, stream: int) -> np.ndarray:
    """The first n odd multipliers of a stream; a longer request has the same beginning."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(steps + np.full(1, stream, np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and len + 1 offsets from 0; a null has no bytes."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        _, at = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            last = min(last, batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()  # an idle worker keeps little


def segment_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, stream: int) -> np.ndarray:
    """A 64-bit hash of each byte segment; segments don't overlap and are in order."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    factors = multipliers(int(lengths.max()) + 1, stream)
    reach = np.cumsum(lengths)
    first = 0
    while first < len(starts):
        done = reach[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(reach, done + _HASH_BYTES, "right")))
        n = lengths[first:last]
        begin = np.cumsum(n) - n
        inside = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(begin, n)
        bytes_ = raw[inside + np.repeat(starts[first:last], n)].astype(np.uint64) + np.uint64(1)
        parts = np.zeros(last - first, np.uint64)
        some = n > 0
        if some.any():
            parts[some] = np.add.reduceat(bytes_ * factors[inside], begin[some])
        out[first:last] = mix64(parts + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        first = last
    return out


@dataclass
class Words:
    """Words of a slice of rows; words of row i are ``at[i]:at[i + 1]``."""

    raw: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, lower: bool = False, plain: bool = False, apart: np.ndarray | None = None) -> Words:
        """``plain``: ASCII marks other than letters and digits separate words too. ``apart``: a table of the bytes that separate words instead."""
        raw, rows = text_bytes(column)
        if lower:
            raw = _LOWER[raw]
        if apart is None:
            apart = _MARK if plain else _SEPARATOR
        inside = ~apart[raw]
        head = inside.copy()
        head[1:] &= ~inside[:-1]
        tail = inside.copy()
        tail[:-1] &= ~inside[1:]
        edges = rows[1:-1]
        edges = edges[(edges > 0) & (edges < len(raw))]
        head[edges] = inside[edges]
        tail[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
        return cls(raw, rows, starts, ends, np.searchsorted(starts, rows))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return segment_hashes(self.raw, self.starts, self.ends, 1)

    def bytes_of(self, row: int) -> list[bytes]:
        """The row's words; the separators of ``bytes.split`` are those of this module."""
        return self.raw[self.rows[row] : self.rows[row + 1]].tobytes().split()


def texts_of(w: Words, words: np.ndarray, size: int = 1) -> pa.Array:
    """Runs of ``size`` words from the given ones on, each joined by one space."""
    columns = []
    for k in range(size):
        begin, end = w.starts[words + k], w.ends[words + k]
        ends = np.concatenate([[0], np.cumsum(end - begin)])
        inside = np.arange(ends[-1]) - np.repeat(ends[:-1] - begin, end - begin)
        columns.append(pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(w.raw[inside]))))
    joined = columns[0] if size == 1 else pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string()))
    return joined.cast(pa.string())


def window_hashes(hashes: np.ndarray, size: int, stream: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` consecutive hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for factor, k in zip(multipliers(size, stream), range(size), strict=True):
        out += hashes[k : k + n] * factor
    return mix64(out)


def windows_in_rows(at: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` words that lie within one row."""
    total = int(at[-1])
    if total < size:
        return np.zeros(0, np.int64)
    last = np.repeat(at[1:], np.diff(at))
    starts = np.arange(total)
    return starts[starts + size <= last]


def covered(starts: np.ndarray, size: int | np.ndarray, total: int) -> np.ndarray:
    """Which of ``total`` positions lie in a window that begins at ``starts``."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0
