"""An index in cells, and exact search that skips cells.

Coarse k-means deals vectors into cells, each a partition of the index table with its centroid and
radius beside it. By the triangle inequality no vector of a cell is nearer to a query than the
centroid's distance less the radius. A query first searches its nearest cells; the k-th distance found
there tells which other cells can still hold a nearer vector, and only their partitions are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from corpusops.operators.vectors import DEFAULT_K, SLICE_BYTES, _best_of, _finite, _matrix, current_version, publish, search
from corpusops.session import durable

CELLS = 64
ROUNDS = 10
# vectors that the centroids are fitted on at most, drawn by a hash of the id; every vector gets a cell
FIT_ROWS = 1 << 16
SEED = 42
# vectors that are not finite lie in no cell; they are infinitely far from all
LOOSE = -1


def _centroids(index: DataFrame, cells: int, id_col: str, vector: str) -> np.ndarray:
    values = F.col(vector).cast("array<double>")
    fit = index.where(_is_finite(vector)).select(values.alias("v"), F.xxhash64(id_col).alias("draw"))
    n = fit.count()
    if not n:
        return np.zeros((0, 0))
    share = F.lit(min(1.0, 2 * FIT_ROWS / n))
    drawn = fit.where(F.shiftrightunsigned("draw", 11) / float(1 << 53) <= share).orderBy("draw").limit(FIT_ROWS)
    sample = durable(drawn.select(array_to_vector("v").alias("features")))
    model = KMeans(k=min(cells, n), maxIter=ROUNDS, seed=SEED).fit(sample)
    return np.array(model.clusterCenters())


def _is_finite(vector: str):
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """From the differences, one centre at a time: bounds must not suffer from cancellation."""
    return np.stack([np.sqrt(((vectors - c) ** 2).sum(1)) for c in centres], 1) if len(centres) else np.zeros((len(vectors), 0))


def save_cells(index: DataFrame, path: str, cells: int = CELLS, id_col: str = "id", vector: str = "embedding") -> str:
    """Write the index partitioned by ``cell``, and per cell its centroid, radius and number of rows.

    A new version is written and then pointed to, as ``publish`` does, so the version before stays readable.
    An index without rows fails before anything is written.
    """
    if index.isEmpty():
        raise ValueError("no rows to index")
    return publish(index.sparkSession, path, lambda folder: _write_cells(index, folder, cells, id_col, vector))


def _write_cells(index: DataFrame, path: str, cells: int, id_col: str, vector: str) -> None:
    spark = index.sparkSession
    centres = _centroids(index, cells, id_col, vector)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.full(batch.num_rows, LOOSE), np.zeros(batch.num_rows)
            fine = np.flatnonzero(batch.column("_fine").to_numpy(zero_copy_only=False))
            for low in range(0, len(fine), 4096):
                some = fine[low : low + 4096]
                near = _distances(_matrix(batch.column(vector).take(pa.array(some)), centres.shape[1]), centres)
                cell[some] = near.argmin(1)
                away[some] = near.min(1)
            rest = [batch.column(c) for c in batch.schema.names if c != "_fine"]
            names = [c for c in batch.schema.names if c != "_fine"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(cell.astype(np.int32)), pa.array(away)], [*names, "cell", "to_centre"])

    schema = T.StructType([*index.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("to_centre", T.DoubleType())])
    placed = index.withColumn("_fine", _is_finite(vector)).mapInArrow(place, schema)
    # a cell's rows lie together, a large cell's over several tasks
    spreads = F.pmod(F.xxhash64(id_col), F.lit(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    placed.repartition("cell", spreads).write.partitionBy("cell").parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows") if len(centres) else None
    sizes = {r.cell: (r.n, r.radius) for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("to_centre").alias("radius")).collect()} if rows else {}
    told = [(c, n, r, centres[c].tolist() if c != LOOSE else []) for c, (n, r) in sorted(sizes.items())]
    spark.createDataFrame(told, "cell int, n long, radius double, centre array<double>").coalesce(1).write.parquet(f"{path}/cells")


def load_cells(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, cells) of a saved index."""
    folder = current_version(spark, path)
    return spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/cells")


def _in_cells(rows: DataFrame, wanted: dict[int, list[int]], asked: pa.Table, k: int, out: T.StructType) -> DataFrame:
    """k rows per query from each task, of the cells that the query wants; other cells are not read."""
    matrix = _matrix(asked.column("vector"), None)
    names = asked.column("query_id").to_pandas()
    shared = rows.sparkSession.sparkContext.broadcast((names, matrix, {c: np.array(q) for c, q in wanted.items()}))
    read = rows.where(F.col("cell").isin(sorted(wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, wanted = shared.value
        for batch in batches:
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            for c in np.unique(cell):
                who = wanted[int(c)]
                yield from _best_of(names.iloc[who].reset_index(drop=True), matrix[who], [batch.filter(pa.array(cell == c))], k, None)

    return read.mapInArrow(run, out)


def search_cells(
    rows: DataFrame, cells: DataFrame, queries: DataFrame, k: int = DEFAULT_K, id_col: str = "id",
    vector: str = "embedding", query_id: str = "query_id", slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Exactly what ``search`` over all rows finds: (query_id, rank, id, distance), ties to the smaller id.

    Queries of up to one slice use the cells; more of them, or vectors that are not finite among the
    nearest k, search all rows. Query ids must be unique.
    """
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("vector"))
    count, dims = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    whole = lambda: search(rows, queries, k, id_col, vector, query_id, slice_bytes=slice_bytes)
    # one row per cell; a few thousand numbers each
    known = [r for r in cells.orderBy("cell").collect() if r.cell != LOOSE]
    if not count or not known or count * dims * 8 > slice_bytes or sum(r.n for r in known) < k:
        return whole()
    table = asked.toArrow()
    matrix = _finite(_matrix(table.column("vector"), dims))
    if np.isnan(matrix).any():
        return whole()
    held = rows.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"), "cell")
    out = T.StructType([asked.schema["query_id"], held.schema["id"], T.StructField("distance", T.DoubleType())])
    centres, radii, sizes = np.array([r.centre for r in known]), np.array([r.radius for r in known]), np.array([r.n for r in known])
    away = _distances(matrix, centres)
    # the nearest cells that hold k rows between them
    order = np.argsort(away, axis=1, kind="stable")
    filled = np.cumsum(sizes[order], axis=1) - sizes[order] < k
    first: dict[int, list[int]] = {}
    for q, at in zip(*np.nonzero(filled)):
        first.setdefault(known[order[q, at]].cell, []).append(int(q))
    found = durable(_in_cells(held, first, table, k, out))
    best = W.partitionBy("query_id").orderBy("distance", "id")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    reach = {r.query_id: r.distance for r in top.groupBy("query_id").agg(F.max("distance").alias("distance")).collect()}
    bound = np.array([reach[q] for q in table.column("query_id").to_pylist()])
    # rounding of the three distances is far below this
    room = 1e-9 * (1 + away + radii + bound[:, None])
    still = away - radii <= bound[:, None] + room
    second: dict[int, list[int]] = {}
    for q, c in zip(*np.nonzero(still)):
        if q not in first.get(known[c].cell, ()):
            second.setdefault(known[c].cell, []).append(int(q))
    every = found.union(_in_cells(held, second, table, k, out)) if second else found
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "distance")
