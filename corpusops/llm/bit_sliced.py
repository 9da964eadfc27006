"""Exact top-k inner products by a bit-sliced index.

Rows are indexed in blocks: one bitmap per attribute and bit. A query adds the slices of all
attributes, weighted by its own components, with carry-save adders on bitmaps; the slices of the sum
then select the top rows from the most significant one downward, and the rows at the boundary are
resolved by exact scores and ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

ROW_BLOCK = 8192
QUERY_BLOCK = 512
# queries whose bitmaps are added side by side
TOGETHER = 64


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def slices_of(values: np.ndarray) -> np.ndarray:
    """(attribute, bit, word) bitmaps over the rows of non-negative values."""
    n, d = values.shape
    bits = max(1, int(values.max(initial=0)).bit_length())
    padded = np.zeros((d, bits, -(-n // 64) * 64), np.uint8)
    for b in range(bits):
        padded[:, b, :n] = (values >> b & 1).T
    return np.packbits(padded, axis=2, bitorder="little").view("<u8")


def sum_slices(index: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of each row's weighted sum, lowest first: (query, word) bitmaps.

    A negative weight adds the complement of an attribute, which orders rows the same way.
    """
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    size = np.abs(weights)
    turned = np.where(weights < 0, ones, np.uint64(0))
    width = int(size.max(initial=0)).bit_length()
    levels: list[list[np.ndarray]] = [[]]

    def add(bitmap: np.ndarray, level: int) -> None:
        while True:
            if level == len(levels):
                levels.append([])
            held = levels[level]
            held.append(bitmap)
            if len(held) < 3:
                return
            a, b, c = held
            both = a ^ b
            levels[level] = [both ^ c]
            bitmap, level = (a & b) | (both & c), level + 1

    masks = [np.where(size >> c & 1, ones, np.uint64(0)) for c in range(width)]
    for d in range(index.shape[0]):
        for b in range(index.shape[1]):
            rows = index[d, b][None, :] ^ turned[:, d, None]
            for c, mask in enumerate(masks):
                add(rows & mask[:, d, None], b + c)
    out, level = [], 0
    while level < len(levels):
        held = levels[level]
        if len(held) == 2:
            levels[level] = [held[0] ^ held[1]]
            add(held[0] & held[1], level + 1)
        out.append(levels[level][0] if levels[level] else np.zeros((len(weights), index.shape[2]), np.uint64))
        level += 1
    return out


def top_rows(sums: list[np.ndarray], valid: np.ndarray, k: int) -> np.ndarray:
    """Bitmaps of the k largest rows per query, with all rows that tie at the boundary."""
    chosen, open_ = np.zeros_like(valid), valid.copy()
    for bitmap in reversed(sums):
        high = open_ & bitmap
        count = np.bitwise_count(chosen | high).sum(axis=1, dtype=np.int64)[:, None]
        chosen = np.where(count <= k, chosen | high, chosen)
        open_ = np.where(count > k, high, open_ & ~bitmap)
    return chosen | open_


def block_top(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query_id, vec_id, score) of each query's k best rows of a block."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    index = slices_of(rows - rows.min(axis=0, initial=np.iinfo(np.int64).max))
    live = slices_of(np.ones((len(rows), 1), np.int64))[0, 0]
    found: list[tuple] = []
    for low in range(0, len(queries), TOGETHER):
        some, some_ids = queries[low : low + TOGETHER], query_ids[low : low + TOGETHER]
        valid = np.repeat(live[None, :], len(some), 0)
        first, last = np.searchsorted(ids, some_ids, "left"), np.searchsorted(ids, some_ids, "right")
        for j in np.flatnonzero(first < last):
            for r in range(first[j], last[j]):
                valid[j, r // 64] &= ~(np.uint64(1) << np.uint64(r % 64))
        best = top_rows(sum_slices(index, some), valid, k)
        flags = np.unpackbits(best.view(np.uint8), axis=1, bitorder="little")
        for j in range(len(some)):
            at = np.flatnonzero(flags[j])
            score = rows[at] @ some[j]
            keep = np.lexsort((ids[at], -score))[:k]
            found.append((np.full(len(keep), some_ids[j]), ids[at][keep], score[keep]))
    return tuple(np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else ((), (), ())))


def top_k(
    rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products, ties to smaller ids.

    Components become floor(scale * x). Vectors that are null or hold null or non-finite components,
    and rows without an id, take no part; vectors meet those of their own length. A row is no
    candidate for a query with its own id. Rows that repeat an id are candidates each; a query id
    that repeats is asked once, with its least vector. Fewer candidates than k are all returned; an
    empty table gives no rows. Components whose products could sum to more than 64 bits hold end the job.
    """
    fit = rows.where(usable(F.col(vector)) & F.col(vec_id).isNotNull() & (F.size(vector) > 0))
    whole = fit.select(
        F.col(vec_id).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(scale * x.cast("double"))).alias("v"), is_query.alias("asks")
    )
    # taken before the floor, which would keep what is too large within 64 bits
    size = F.array_max(F.transform(vector, lambda x: F.abs(scale * x.cast("double")) + 1))
    n, asked, largest, longest = fit.agg(F.count("*"), F.count_if(is_query), F.max(size), F.max(F.size(vector))).first()
    # the index holds differences of two components
    if n and largest > math.isqrt((1 << 62) // longest) / 2:
        raise ValueError(f"components to {largest / scale:g} are too large for inner products in 64 bits")
    row_blocks, query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-asked // QUERY_BLOCK))
    # every row block meets every block of the stated query set
    blocks = whole.select(
        "id", "v", F.size("v").alias("d"), (F.monotonically_increasing_id() % row_blocks).alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("c"),
    )
    queries = whole.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    dealt = queries.select(
        "id", "v", F.size("v").alias("d"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("b"),
        F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("c"),
    )

    def matrix(table: pa.Table) -> np.ndarray:
        flat = table.column("v").combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            found = [np.zeros(0, np.int64)] * 3
        else:
            found = block_top(matrix(left), left.column("id").to_numpy(), matrix(right), right.column("id").to_numpy(), k)
        return pa.table([pa.array(c, pa.int64()) for c in found], ["query_id", "vec_id", "score"])

    keys = ["b", "c", "d"]
    local = blocks.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
