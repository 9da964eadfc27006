"""Approximate nearest neighbours by shifted space-filling curves.

Each of several orderings projects the vectors on a few random directions, shifts them, and sorts
them along a Hilbert curve in range partitions. What lies in a window around a query on any curve is
a candidate; candidates are scored exactly, and the windows of all curves are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusops.llm.bit_sliced import usable
from corpusops.session import durable

CURVES = 48
DIRECTIONS = 10
BITS = 3
# share of a curve on either side of a query that is scored, and the least number of places
WINDOW_SHARE = 0.01
LEAST_WINDOW = 64
BLOCK = 8192
SEED = 20240


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (row of coordinates below 2 ** bits) along the Hilbert curve."""
    axes = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        top = one << np.uint64(level)
        rest = top - one
        for i in range(len(axes)):
            inverted = (axes[i] & top) != 0
            # a set bit mirrors the first axis, a clear one exchanges the lower bits with it
            swap = np.where(inverted, np.uint64(0), (axes[0] ^ axes[i]) & rest)
            axes[0] ^= np.where(inverted, rest, swap)
            if i:
                axes[i] ^= swap
    gray = np.bitwise_xor.accumulate(axes, axis=0)
    turn = np.zeros(axes.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        top = one << np.uint64(level)
        turn ^= np.where((gray[-1] & top) != 0, top - one, np.uint64(0))
    gray ^= turn
    key = np.zeros(axes.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in gray:
            key = key << one | (axis >> np.uint64(level)) & one
    return key


def curve_keys(unit: np.ndarray, curve: int) -> np.ndarray:
    """Keys of unit vectors on one shifted curve."""
    draw = np.random.default_rng([SEED, curve, unit.shape[1]])
    directions = np.linalg.qr(draw.normal(size=(unit.shape[1], DIRECTIONS)))[0] if unit.shape[1] >= DIRECTIONS else np.eye(unit.shape[1])
    shift = draw.uniform(-0.25, 0.25, size=directions.shape[1])
    # a unit vector's coordinate is some 1 / sqrt(d) wide; two deviations either way span the grid
    place = unit @ directions * np.sqrt(unit.shape[1]) / 4.4 + 0.5 + shift
    cells = np.clip(np.floor(place * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.uint64)
    return hilbert_keys(cells, BITS)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _whole_scale(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component near one, so that no square over- or underflows; cosines stay as they are."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -power[:, None])


def nearest(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", curves: int = CURVES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found by cosine, ties to smaller ids.

    Vectors that are null or zero or hold null or non-finite components, and rows without an id, take
    no part; vectors meet those of their own length. A row is no candidate for a query with its own
    id. Of equal vectors the k + 1 smallest ids are candidates, which no result can exceed. A query
    id that repeats is asked once, with its least vector. All candidates are returned if there are
    fewer than k; an empty table gives no rows.
    """
    fit = rows.where(usable(F.col(vector)) & F.col(vec_id).isNotNull() & F.exists(vector, lambda x: x != 0))
    whole = fit.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("asks"))
    n = max(1, whole.count())
    window = max(LEAST_WINDOW, int(np.ceil(WINDOW_SHARE * n)))
    block = min(2 * window, BLOCK)
    same = F.row_number().over(W.partitionBy("v").orderBy("id"))
    held = whole.select("id", "v").withColumn("nth", same).where(F.col("nth") <= k + 1).select("id", "v", F.lit(False).alias("asks"))
    asked = whole.where("asks").groupBy("id").agg(F.min("v").alias("v")).select("id", "v", F.lit(True).alias("asks"))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                unit = _whole_scale(_matrix(some.column("v")))
                unit /= np.linalg.norm(unit, axis=1)[:, None]
                for curve in range(curves):
                    key = curve_keys(unit, curve).astype(np.int64)
                    group = pa.array(np.full(len(key), int(size) * curves + curve))
                    yield pa.RecordBatch.from_arrays([group, pa.array(key), *some.columns], ["curve", "key", *some.schema.names])

    kind = whole.schema["v"].dataType.simpleString()
    keyed = held.union(asked).mapInArrow(order, f"curve long, key long, id long, v {kind}, asks boolean")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, part)), place, *batch.columns], ["part", "place", *batch.schema.names])

    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), curves)
    lined = keyed.repartitionByRange(tasks, "curve", "key", "id").sortWithinPartitions("curve", "key", "id")
    table = durable(lined.mapInArrow(number, f"part long, place long, curve long, key long, id long, v {kind}, asks boolean"))
    # one number per partition
    before, offsets = 0, []
    for r in table.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        offsets.append((r.part, before))
        before += r.n
    starts = rows.sparkSession.createDataFrame(offsets, "part long, before long")
    placed = table.join(F.broadcast(starts), "part").withColumn("at", F.col("before") + F.col("place"))
    blocks = placed.where(~F.col("asks")).select("curve", F.floor(F.col("at") / block).alias("block"), "at", "id", "v")
    reach = F.sequence(F.floor((F.col("at") - window) / block), F.floor((F.col("at") + window) / block))
    asks = placed.where("asks").select(
        F.col("curve").alias("q_curve"), F.explode(reach).alias("q_block"), F.col("at").alias("q_at"), F.col("id").alias("q_id"), F.col("v").alias("q_v")
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            rows, ids, at = _whole_scale(_matrix(left.column("v"))), left.column("id").to_numpy(), left.column("at").to_numpy()
            length = np.sqrt((rows * rows).sum(axis=1))
            for low in range(0, right.num_rows, 256):
                some = right.slice(low, 256)
                queries, own, place = _whole_scale(_matrix(some.column("q_v"))), some.column("q_id").to_numpy(), some.column("q_at").to_numpy()
                rough = queries @ (rows / length[:, None]).T
                rough[(np.abs(place[:, None] - at) > window) | (own[:, None] == ids)] = -np.inf
                for j in range(len(own)):
                    live = np.isfinite(rough[j]).sum()
                    if not live:
                        continue
                    size = np.sqrt((queries[j] * queries[j]).sum())
                    # products of matrices may differ in the last bits between equal rows
                    edge = np.partition(rough[j], len(ids) - min(k, live))[len(ids) - min(k, live)] - 1e-9 * size
                    near = np.flatnonzero(rough[j] >= edge)
                    score = (rows[near] * queries[j]).sum(axis=1) / (length[near] * size)
                    best = np.lexsort((ids[near], -score))[:k]
                    found.append((np.full(len(best), own[j]), ids[near][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(columns, ["query_id", "vec_id", "score"])

    local = blocks.groupBy("curve", "block").cogroup(asks.groupBy("q_curve", "q_block")).applyInArrow(search, "query_id long, vec_id long, score double")
    merged = local.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
