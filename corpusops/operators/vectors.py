"""Embedding of text, vector tables and exact top-k search.

Queries that fit one slice are broadcast: each task scans its part of the index against them and
keeps k rows per query, so the index is never shuffled. Larger query sets never pass the driver:
index and queries are dealt into blocks of bounded size, and every pair of blocks meets in one task.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from corpusops.sources.guards import require_path

# Fixed value: hits per search unless the caller asks otherwise, and the message for none.
DEFAULT_K = 4
NO_RESULTS = "No relevant code found."

SLICE_BYTES = 32 << 20
# distances held at once by one task
BLOCK_CELLS = 1 << 21
PAIR_BLOCK = 1 << 15
# tokens, vector components or code points that a Python worker turns into arrays at once, whatever a batch holds
RUN_CELLS = 1 << 20
# an index's versions, the file that names the one in use, and the mark of a complete one; readers of tables skip such names
VERSIONS, POINTER, COMPLETE = "_versions", "_current", "_COMPLETE"
# rough size of a hit: four values
HIT_BYTES = 64


# ---------------------------------------------------------------- text to vector


def embed_text(file="file", name="name", kind="type", docstring="docstring", code="code") -> Column:
    """Header line, quoted docstring where there is one, then the code."""
    header = F.format_string("# %s::%s (%s)", file, name, kind)
    quoted = F.when(F.col(docstring) != "", F.format_string('"""%s"""', docstring))
    return F.concat_ws("\n", header, quoted, code)


def raw_tokens(text: Column) -> Column:
    """Lower-case words; empty strings at the ends do not count as tokens."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+")


def _slot(token: str, dims: int) -> int:
    """Slot of a token in a hashed vocabulary; md5 makes it the same in any engine. -1 is no token."""
    return int(hashlib.md5(token.encode()).hexdigest()[:6], 16) % dims if token else -1


def _runs(lengths: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Row runs of at most ``rows`` rows and some ``RUN_CELLS`` values, at least one row."""
    ends, low = np.cumsum(lengths), 0
    while low < len(ends):
        full = np.searchsorted(ends, (ends[low - 1] if low else 0) + RUN_CELLS, "right")
        high = max(low + 1, min(low + rows, int(full)))
        yield low, high
        low = high


def _slot_counts(tokens: pa.ListArray, dims: int) -> Iterator[np.ndarray]:
    """Token counts per slot, as matrices of some rows each.

    Equal tokens of such rows are hashed once; the rest is index arithmetic.
    """
    lengths = tokens.value_lengths().to_numpy(zero_copy_only=False)
    for low, high in _runs(lengths, max(1, RUN_CELLS // dims)):
        coded = tokens.slice(low, high - low).flatten().dictionary_encode()
        slot_of = np.array([_slot(t, dims) for t in coded.dictionary.to_pylist()], dtype=np.int64)
        slots = slot_of[coded.indices.to_numpy(zero_copy_only=False)]
        rows = np.repeat(np.arange(high - low), lengths[low:high])
        real = slots >= 0
        cells = rows[real] * dims + slots[real]
        yield np.bincount(cells, minlength=(high - low) * dims).reshape(high - low, dims)


def slot_weights(docs: DataFrame, text: str, dims: int) -> np.ndarray:
    """Inverse document frequency per slot, ``ln((n + 1) / (df + 1))``: ``dims`` numbers on the driver.

    Each task sends one count per slot, and the number of its rows as slot -1.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, rows = np.zeros(dims, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for counts in _slot_counts(batch.column(0), dims):
                present += (counts > 0).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"slot": np.arange(-1, dims), "n": np.append(rows, present)})

    counted = docs.select(raw_tokens(F.col(text)).alias("tokens")).mapInArrow(count, "slot bigint, n bigint")
    df = np.zeros(dims + 1)
    for slot, n in counted.groupBy("slot").agg(F.sum("n")).collect():
        df[slot] = n
    return np.log((df[-1] + 1) / (df[:-1] + 1))


def _unit_vectors(tokens: pa.ListArray, weights: np.ndarray) -> Iterator[np.ndarray]:
    """Token counts times slot weights at length one, as matrices of some rows each."""
    for counts in _slot_counts(tokens, len(weights)):
        block = counts * weights
        norms = np.sqrt(np.einsum("ij,ij->i", block, block))
        yield block / np.where(norms > 0, norms, 1.0)[:, None]


def weighed_tokens(tokens: Column, weights: np.ndarray) -> Column:
    """Unit vector of token counts times slot weights; all zero when nothing carries weight."""
    dims = len(weights)

    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for block in _unit_vectors(batch, weights):
                yield pa.ListArray.from_arrays(np.arange(len(block) + 1, dtype=np.int32) * dims, block.ravel())

    return F.arrow_udf(build, "array<double>")(tokens)


class HashedEmbedder:
    """Hashed TF-IDF vectors: ``fit`` on the index side, ``embed`` either side."""

    def __init__(self, dims: int = 256):
        self.dims = dims
        self.weights: np.ndarray | None = None

    def fit(self, docs: DataFrame, text: str = "text") -> HashedEmbedder:
        self.weights = slot_weights(docs, text, self.dims)
        return self

    def save(self, spark: SparkSession, path: str) -> str:
        rows = [(slot, float(weight)) for slot, weight in enumerate(self.weights)]
        spark.createDataFrame(rows, "slot int, weight double").coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HashedEmbedder:
        rows = spark.read.parquet(require_path(spark, path, f"no embedder at {path}")).orderBy("slot").collect()
        embedder = cls(len(rows))
        embedder.weights = np.array([r["weight"] for r in rows])
        return embedder

    def embed(self, docs: DataFrame, text: str = "text", out: str = "embedding") -> DataFrame:
        return docs.withColumn(out, weighed_tokens(raw_tokens(F.col(text)), self.weights))


class ModelEmbedder:
    """Vectors from a caller's model: ``encode(list of texts) -> 2-d array``, loaded once per task."""

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]]):
        self.load = load

    def embed(self, docs: DataFrame, text: str = "text", out: str = "embedding") -> DataFrame:
        load = self.load

        @F.pandas_udf("array<float>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                yield pd.Series(list(np.asarray(model(batch.tolist()), dtype=np.float32)))

        return docs.withColumn(out, encode(F.col(text)))


# ---------------------------------------------------------------- index tables


def with_checked_vectors(df: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """Fails on a vector of another length, before it reaches an index."""
    wrong = F.raise_error(F.format_string(f"vector has %d dimensions, not {dims}", F.size(vector)))
    checked = F.when(F.size(vector) == dims, F.col(vector)).otherwise(wrong.cast(df.schema[vector].dataType))
    return df.withColumn(vector, checked)


def build_index(chunks: DataFrame, embedder, path: str) -> int:
    """Embed chunks and write the index; returns its number of rows.

    An empty corpus fails before anything is written, and a failing embedder before the pointer moves,
    so an index that is there stays.
    """
    return build_index_observed(chunks, embedder, path)["rows"]


def build_index_observed(chunks: DataFrame, embedder, path: str) -> dict:
    """``build_index`` with what the one pass saw: rows, characters of text, seconds and rows per second."""
    if chunks.isEmpty():
        raise ValueError("no indexable chunks")
    seen, began = Observation(), time.perf_counter()
    embedded = embedder.embed(chunks.withColumn("content", embed_text()), "content")
    told = embedded.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.length("content").cast("bigint")).alias("chars"))
    save_index(told, path)
    seconds = time.perf_counter() - began
    return {**seen.get, "seconds": seconds, "rows_per_second": seen.get["rows"] / seconds}


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def save_index(vectors: DataFrame, path: str) -> str:
    """Write a new version of the index below ``path`` and point to it."""
    return publish(vectors.sparkSession, path, lambda folder: vectors.write.parquet(folder))


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new version's folder below ``path``, then point to it.

    Each version has a folder of its own. The pointer is replaced in one rename once the version is
    complete, so a job that fails, and a reader at work, keep the version before; older ones go.
    """
    jvm = spark.sparkContext._jvm
    version = uuid.uuid4().hex
    write(f"{path}/{VERSIONS}/{version}")
    before = _pointed(spark, path)
    done, fs = _file_system(spark, f"{path}/{VERSIONS}/{version}/{COMPLETE}")
    fs.create(done, True).close()
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}.{version}")
    out = fs.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(_file_system(spark, f"{path}/{POINTER}")[0]), options)
    for status in fs.listStatus(_file_system(spark, f"{path}/{VERSIONS}")[0]):
        # a version that another job still writes has no mark
        folder = status.getPath()
        if folder.getName() not in (version, before) and fs.exists(jvm.org.apache.hadoop.fs.Path(folder, COMPLETE)):
            fs.delete(folder, True)
    return path


def _pointed(spark: SparkSession, path: str) -> str | None:
    """The version an index points to."""
    target, fs = _file_system(spark, f"{path}/{POINTER}")
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current_version(spark: SparkSession, path: str) -> str:
    """The folder of the version that was last completed."""
    require_path(spark, f"{path}/{POINTER}", f"no index at {path}: build and save one first")
    return f"{path}/{VERSIONS}/{_pointed(spark, path)}"


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """The version of the index that was last completed."""
    return spark.read.parquet(current_version(spark, path))


# ---------------------------------------------------------------- search


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    id_col: str = "id",
    vector: str = "embedding",
    query_id: str = "query_id",
    digits: int | None = None,
    slice_bytes: int = SLICE_BYTES,
    embedder: HashedEmbedder | None = None,
) -> DataFrame:
    """The k nearest index rows of each query by L2 distance: (query_id, rank, id, distance).

    Exact distances rank, ties go to the smaller id. ``digits`` rounds distances before they rank,
    for callers whose vectors carry rounding noise of their own. A vector with a NaN, infinite or
    null component is infinitely far from all, on either side. With fewer than k index rows, all
    are hits. With an ``embedder`` the index holds ``text`` instead of vectors: a scan makes them where
    it compares them, some rows at a time.
    """
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("vector"))
    if embedder is None:
        held = index.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    else:
        held = index.select(F.col(id_col).alias("id"), F.col("text"))
    out = T.StructType([asked.schema["query_id"], held.schema["id"], T.StructField("distance", T.DoubleType())])
    count, dims = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    query_bytes = count * (dims or 1) * 8
    if query_bytes <= slice_bytes:
        found = _scan(held, asked, k, digits, out, embedder)
    else:
        held = held if embedder is None else embedder.embed(held, out="vector").drop("text")
        blocks = max(1, -(-held.count() * (dims or 1) * 8 // slice_bytes))
        found = _blocked(held, asked, k, digits, out, blocks, -(-query_bytes // slice_bytes))
    best = W.partitionBy("query_id").orderBy("distance", "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    hits = ranked.select("query_id", "rank", "id", "distance")
    # at most k rows per query, counted above: few hits need not shuffle the table they are joined to
    return hits.hint("broadcast") if k * count * HIT_BYTES <= slice_bytes else hits


def _scan(
    index: DataFrame, queries: DataFrame, k: int, digits: int | None, out: T.StructType, embedder: HashedEmbedder | None = None
) -> DataFrame:
    """k rows per query from each task; ``queries`` is one slice of bounded size."""
    asked = queries.toArrow()
    matrix = _matrix(asked.column("vector"), None)
    shared = index.sparkSession.sparkContext.broadcast((asked.column("query_id").to_pandas(), matrix))
    encode = None
    if embedder is not None:
        index, weights = index.select("id", raw_tokens(F.col("text")).alias("vector")), embedder.weights

        def encode(tokens: pa.ListArray) -> Iterator[np.ndarray]:
            return _unit_vectors(tokens, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _best_of(*shared.value, batches, k, digits, encode)

    return index.mapInArrow(run, out)


def _blocked(
    index: DataFrame, queries: DataFrame, k: int, digits: int | None, out: T.StructType, blocks: int, slices: int
) -> DataFrame:
    """k rows per query from each pair of an index block and a query slice, both of bounded size."""

    def dealt(rows: DataFrame, key: str, own: str, parts: int, other: str, copies: int) -> DataFrame:
        place = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias(own)
        return rows.select("*", place, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))

    held = dealt(index, "id", "block", blocks, "slice", slices)
    asked = dealt(queries, "query_id", "slice", slices, "block", blocks)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, matrix = right.column("query_id").to_pandas(), _matrix(right.column("vector"), None)
        found = list(_best_of(names, matrix, left.to_batches(), k, digits))
        return pa.Table.from_batches(found) if found else pa.table([right.column(0).slice(0, 0), left.column(0).slice(0, 0), pa.array([], "double")], ["query_id", "id", "distance"])

    keys = ["block", "slice"]
    return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, out)


def _best_of(
    names: pd.Series,
    asked: np.ndarray,
    batches: Iterable[pa.RecordBatch],
    k: int,
    digits: int | None,
    encode: Callable[[pa.Array], Iterator[np.ndarray]] | None = None,
) -> Iterator[pa.RecordBatch]:
    best = None
    for batch in batches:
        if batch.num_rows and len(names):
            low = 0
            for vectors in (encode or _matrices(asked.shape[1]))(batch.column("vector")):
                ids = batch.column("id").slice(low, len(vectors)).to_pandas()
                low += len(vectors)
                near = _near(asked, vectors, ids, k, digits, best)
                if near:
                    best = _merge(best, near, k)
    if best is not None:
        best = best.assign(query_id=names.to_numpy()[best["query"]])
        yield pa.RecordBatch.from_pandas(best[["query_id", "id", "distance"]], preserve_index=False)


def _matrices(dims: int) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """Turns a list column into matrices of some rows each."""
    step = max(1, RUN_CELLS // max(1, dims))
    return lambda column: (_matrix(column.slice(low, step), dims) for low in range(0, len(column), step))


def _matrix(vectors, dims: int | None) -> np.ndarray:
    """Rows of a list column as one matrix of doubles; rows of unequal length are an error."""
    values = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = set(values.value_lengths().unique().to_pylist()) if len(values) else {dims or 0}
    if len(lengths) > 1 or (dims is not None and lengths != {dims}):
        raise ValueError(f"vector lengths {sorted(lengths, key=str)} where {dims or 'one length'} is wanted")
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(values), lengths.pop())


def _finite(vectors: np.ndarray) -> np.ndarray:
    """Rows with a component that is no finite number become NaN throughout."""
    good = np.isfinite(vectors).all(axis=1)
    return vectors if good.all() else np.where(good[:, None], vectors, np.nan)


def _near(
    asked: np.ndarray, held: np.ndarray, ids: pd.Series, k: int, digits: int | None, best: pd.DataFrame | None
) -> list[pd.DataFrame]:
    """Rows that may be among the k best of a query, with exact distances; often none once ``best`` is good.

    A matrix product ranks them; its rounding error and the rounding of distances are allowed for
    in the cut, and the survivors' distances are taken again from the differences.
    """
    bound = np.full(len(asked), np.inf)
    if best is not None:
        full = best.groupby("query")["distance"].agg(["size", "max"])
        full = full[full["size"] == k]
        bound[full.index] = full["max"]
    held, asked = _finite(held), _finite(asked)
    held_sq = np.einsum("ij,ij->i", held, held)
    asked_sq = np.einsum("ij,ij->i", asked, asked)
    rounding = 0.0 if digits is None else 10.0**-digits
    step = max(1, BLOCK_CELLS // len(held))
    pairs = min(PAIR_BLOCK, max(1, RUN_CELLS // max(1, held.shape[1])))
    parts = []
    for at in range(0, len(asked), step):
        block = slice(at, at + step)
        square = asked_sq[block, None] + held_sq - 2 * (asked[block] @ held.T)
        slack = 1e-12 * (np.nan_to_num(asked_sq[block]) + np.nan_to_num(held_sq).max())
        near = np.sqrt(np.maximum(square, 0))
        near[np.isnan(near)] = np.inf
        limit = bound[block]
        if len(held) > k:
            limit = np.minimum(limit, np.partition(near, k - 1, axis=1)[:, k - 1])
        rows, columns = np.nonzero(near <= (limit + rounding + 2 * np.sqrt(slack))[:, None])
        for cut in range(0, len(rows), pairs):
            row, column = rows[cut : cut + pairs] + at, columns[cut : cut + pairs]
            exact = np.sqrt(((asked[row] - held[column]) ** 2).sum(axis=1))
            exact = np.where(np.isnan(exact), np.inf, exact if digits is None else exact.round(digits))
            parts.append(pd.DataFrame({"query": row, "distance": exact, "id": ids.to_numpy()[column]}))
    return parts


def _merge(best: pd.DataFrame | None, found: list[pd.DataFrame], k: int) -> pd.DataFrame:
    rows = pd.concat(found if best is None else [best, *found])
    return rows.sort_values(["query", "distance", "id"]).groupby("query").head(k).reset_index(drop=True)


# ---------------------------------------------------------------- hits


def describe_hits(hits: DataFrame, chunks: DataFrame, key: str = "id", content: str = "content") -> DataFrame:
    """Five display fields per hit, joined back from the chunk table by its key."""
    fields = chunks.select(
        F.col(key).alias("id"),
        "file",
        "name",
        "type",
        F.format_string("%d-%d", "start_line", "end_line").alias("lines"),
        F.col(content).alias("content"),
    )
    return fields.join(hits, "id")


def rendered_hits(queries: DataFrame, described: DataFrame) -> DataFrame:
    """One text per query: a titled block per hit in rank order, or the message for none."""
    block = F.format_string("--- %s::%s (lines %s) ---\n%s", "file", "name", "lines", "content")
    ordered = F.sort_array(F.collect_list(F.struct("rank", block.alias("block"))))
    texts = described.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda h: h["block"]), "\n\n").alias("output"))
    answered = queries.join(texts, "query_id", "left")
    return answered.select(*queries.columns, F.coalesce("output", F.lit(NO_RESULTS)).alias("output"))


def hit_id() -> Column:
    return F.concat_ws("::", "file", "name")
