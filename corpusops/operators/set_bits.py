"""One bit per member of a set, enough to tell most unlike sets apart without the sets.

A bit says whether an odd number of members fall on it. Two sets that differ in d members differ in
at most d bits, whatever falls together, so what is turned down by bits is never similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# bits of the smallest sets
LEAST = 64


def parity_bits(row: np.ndarray, members: np.ndarray, rows: int) -> pa.Array:
    """The bits of each of ``rows`` sets, given as distinct 64-bit hashes ``members`` of the sets ``row``.

    There are as many as the next power of two from the set's size on.
    """
    sizes = np.bincount(row, minlength=rows)
    width = np.int64(1) << np.ceil(np.log2(np.maximum(sizes, LEAST))).astype(np.int64)
    ends = np.cumsum(width)
    odd = np.zeros(int(ends[-1]) if rows else 0, np.uint8)
    at = (width - 1)[row]
    at &= members.view(np.int64)
    at += (ends - width)[row]
    # a count that wraps at 256 keeps its parity
    np.add.at(odd, at, np.uint8(1))
    packed = np.packbits(odd & 1)
    cuts = np.append(0, ends // 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(cuts), pa.py_buffer(packed)])


def differing(a: bytes, b: bytes) -> int:
    """Bits in which the bits of two sets differ; the wider ones are folded to the width of the others."""
    if len(a) < len(b):
        a, b = b, a
    wide, bits = int.from_bytes(a, "big"), 8 * len(a)
    while bits > 8 * len(b):
        bits //= 2
        wide = (wide >> bits) ^ (wide & ((1 << bits) - 1))
    return (wide ^ int.from_bytes(b, "big")).bit_count()


def may_be_similar(a: bytes, n: int, b: bytes, m: int, shared: int, of: int) -> bool:
    """Whether sets of n and m members with these bits can share ``shared`` / ``of`` of what they hold together."""
    return of * min(n, m) >= shared * max(n, m) and (shared + of) * differing(a, b) <= (of - shared) * (n + m)


def plausible(pairs: DataFrame, u: str, v: str, shared: int, of: int) -> DataFrame:
    """(u, v) of the pairs (u, v, a, n, b, m), with the bits and sizes of both sets, that may have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = zip(*(batch.column(c).to_pylist() for c in ("a", "n", "b", "m")))
            yield batch.select([u, v]).filter(pa.array([may_be_similar(*x, shared, of) for x in held], pa.bool_()))

    return pairs.select(u, v, "a", "n", "b", "m").mapInArrow(run, pairs.select(u, v).schema)
