"""Words and word windows of whole texts as numpy arrays, many documents at once.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Window hashes are polynomial sums
over 64 bits: equal windows have equal hashes, so hashes choose and deal; texts decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

# text per slice: bounds the arrays that are alive at once; a longer document is a slice of its own
SLICE_BYTES = 1 << 18
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD1B54A32D192ED03 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Held(dict):
    """What a process has computed; a pickled one arrives empty, as functions that travel by value take their tables along."""

    def __reduce__(self):
        return dict, ()


_HELD = Held()


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(value: int) -> np.ndarray:
        steps = np.full(size, np.uint64(value))
        steps[:1] = 1
        return np.multiply.accumulate(steps)

    return run(base), run(pow(base, -1, 1 << 64))


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and those of its inverse."""
    held = 1 << max(12, (size - 1).bit_length())
    if held > 8 * SLICE_BYTES:
        return _powers(base, size)
    if (base, held) not in _HELD:
        _HELD[base, held] = _powers(base, held)
    forward, back = _HELD[base, held]
    return forward[:size], back[:size]


def range_hash(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each range, in one pass over values."""
    forward, back = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forward[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts])


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


@dataclass
class Texts:
    """Documents side by side: ``data`` their bytes, document i at offsets[i]:offsets[i + 1]."""

    data: np.ndarray
    offsets: np.ndarray

    @cached_property
    def _edges(self) -> tuple[np.ndarray, np.ndarray]:
        data, cuts = self.data, self.offsets
        solid = np.ones(len(data) + 2, bool)
        solid[1:-1] = (data != 32) & ((data < 9) | (data > 13))
        solid[0] = solid[-1] = False
        inside = solid[1:-1]
        first = inside & ~solid[:-2]
        last = inside & ~solid[2:]
        starts_at = cuts[:-1][cuts[:-1] < cuts[1:]]
        ends_at = cuts[1:][cuts[:-1] < cuts[1:]] - 1
        first[starts_at] |= inside[starts_at]
        last[ends_at] |= inside[ends_at]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    @property
    def starts(self) -> np.ndarray:
        """First byte of each word."""
        return self._edges[0]

    @property
    def ends(self) -> np.ndarray:
        """The byte after each word."""
        return self._edges[1]

    @cached_property
    def first_word(self) -> np.ndarray:
        """Index of each document's first word, and the number of words at the end."""
        return np.searchsorted(self.starts, self.offsets)

    @cached_property
    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first_word))

    @cached_property
    def word_hash(self) -> np.ndarray:
        return range_hash(BYTE_VALUES[self.data], BYTE_BASE, self.starts, self.ends)

    def windows(self, size: int) -> np.ndarray:
        """First word of each window of ``size`` words that lies in one document."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])

    def window_hash(self, size: int, at: np.ndarray) -> np.ndarray:
        return range_hash(self.word_hash, WORD_BASE, at, at + size)

    def joined(self, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Kept words, each with one space behind it, and each kept word's start and end there."""
        starts, ends = (self.starts, self.ends) if keep is None else (self.starts[keep], self.ends[keep])
        sizes = ends - starts + 1
        place = np.concatenate([[0], np.cumsum(sizes)])
        take = np.arange(place[-1]) + np.repeat(starts - place[:-1], sizes)
        out = self.data[np.minimum(take, max(0, len(self.data) - 1))]
        out[place[1:] - 1] = 32
        return out.tobytes(), place[:-1], place[1:] - 1


def texts_of(column: pa.Array) -> Texts:
    """View a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    cuts = np.frombuffer(where, np.int64 if wide else np.int32, len(column) + 1 + column.offset)[column.offset :].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(held[cuts[0] : cuts[-1]], cuts - cuts[0])


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Row runs with about ``limit`` bytes of text each, at least one row."""
    for batch in batches:
        whole = texts_of(batch.column(text)) if batch.num_rows else None
        row = 0
        while row < batch.num_rows:
            until = int(np.searchsorted(whole.offsets, whole.offsets[row] + limit, "right")) - 1
            until = min(batch.num_rows, max(row + 1, until))
            low, high = whole.offsets[row], whole.offsets[until]
            yield batch.slice(row, until - row), Texts(whole.data[low:high], whole.offsets[row : until + 1] - low)
            row = until


def minimisers(hashes: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` neighbouring hashes within a document, the place of its least hash.

    Equal runs choose equal places; among equal hashes the leftmost wins.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(len(hashes))
    reach = 1
    while reach < width:
        # double the covered run: the least of two overlapping runs
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] < hashes[left], right, left)
        reach += step
    runs = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return best[runs]
