"""Words of Arrow text columns as NumPy arrays: positions, hashes, shingles.

A word is a run of ``[^\\x20\\x09-\\x0D]``; ``A-Z`` are lower-cased. Everything
works on whole texts; long batches are cut between rows, never inside one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The same words as a pattern for Spark and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text handled at a time; a longer row is handled alone.
CHUNK = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fold(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the pair ``(left, right)``; the order counts."""
    return mix64(left * _GOLDEN + right)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (null: empty) and the offset of each row, from 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Hand freed memory to the system; a worker would keep it from one stage to the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``CHUNK`` bytes of text, or of one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
            last = max(last, first + 1)
            yield batch.slice(first, last - first)
            first = last
        give_back()


@dataclass
class Words:
    """All words of a batch: ``data[start:end]``, the row of each, words per row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    rows: int

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def word(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word, eight bytes at a time."""
        size = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        lanes = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
        out = mix64((lanes[self.start] & _MASKS[np.minimum(size, 8)]) + _GOLDEN)
        at = 8
        left = np.flatnonzero(size > at)
        while len(left):
            lane = lanes[self.start[left] + at] & _MASKS[np.minimum(size[left] - at, 8)]
            out[left] = fold(out[left], lane)
            at += 8
            left = left[size[left] > at]
        return fold(out, size.astype(np.uint64))


def words(column: pa.Array, lower: bool = True) -> Words:
    data, offsets = raw_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    # a row's edge parts words as white space does
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, end, row, len(offsets) - 1)


def windows(found: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``width`` words inside one row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    out = hashes[:n] + np.uint64(width)
    for k in range(1, width):
        out = fold(out, hashes[k : n + k])
    whole = np.flatnonzero(found.row[:n] == found.row[width - 1 : n + width - 1])
    return out[whole], whole


def shingles(found: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(row, hash)`` of word shingles, ordered by row and hash.

    A row of fewer words gives its whole sequence as its only shingle.
    """
    grams, first = windows(found, hashes, width)
    rows = found.row[first]
    counts = found.counts
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            out = hashes[begin[short]] + np.uint64(n)
            for k in range(1, n):
                out = fold(out, hashes[begin[short] + k])
            grams, rows = np.concatenate([grams, out]), np.concatenate([rows, short])
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    return rows[new], grams[new]
