"""Words and shingles of whole columns of text, as numpy arrays over the UTF-8 bytes of an Arrow batch.

Nothing here loops over words or characters in Python. Slices keep the arrays small; a text longer
than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

#: White space is what separates words: blank and \t \n \v \f \r.
NOT_SPACE = np.array([b not in (32, *range(9, 14)) for b in range(256)])
#: Letters (lower case), digits and everything beyond ASCII.
LETTERS = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all 64 bits, one to one (the splitmix64 finaliser)."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """``bytes``: the text of all rows; ``start``/``end``: bytes of each word; ``first``: the first word of each
    row and, at the end, the number of words; ``offsets``: the rows' bytes."""

    bytes: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, read eight at a time."""
        size = self.end - self.start
        padded = np.concatenate([self.bytes, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.bytes) + 1, "<u8", padded.data, 0, (1,))
        h = mix(size.astype(np.uint64)) ^ (eight[self.start] & _MASKS[np.minimum(size, 8)])
        h = mix(h)
        left, at = np.flatnonzero(size > 8), 8
        while len(left):
            h[left] = mix(h[left] * _M3 ^ (eight[self.start[left] + at] & _MASKS[np.minimum(size[left] - at, 8)]))
            at += 8
            left = left[size[left] > at]
        return h


def split(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begins[edge] = inside[edge]  # a row begins its own words
    stops = inside[:-1] & ~inside[1:]
    edge = offsets[1:][offsets[1:] > 0] - 1
    stops[edge] = inside[edge]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    low, high = offsets[0], offsets[-1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
    return data, offsets - low


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of each part have about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]]) if len(sizes) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(int(a), int(b - a))


def folded(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` neighbours: len(values) - n + 1 of them."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out = values[: len(values) - n + 1].copy()
    for k in range(1, n):
        out = out * _M2 + mix(values[k : len(values) - n + 1 + k] + np.uint64(k))
    return mix(out)


def runs(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and first words of all runs of ``n`` words within a row."""
    rows = words.row
    if len(rows) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :])
    return rows[at], at


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct ``n``-word shingles of each row, sorted by row and hash.

    A row with fewer than ``n`` words has one shingle, all its words; a row without words has none.
    """
    h = words.hashes()
    rows, at = runs(words, n)
    values = folded(h, n)[at] if len(at) else np.zeros(0, np.uint64)
    counts = words.counts
    for k in range(1, n):
        few = np.flatnonzero(counts == k)
        if len(few):
            rows = np.concatenate([rows, few])
            values = np.concatenate([values, folded(h, k)[words.first[few]] ^ mix(np.uint64([k]))])
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]
