"""Product codes of vectors, with codebooks refined over metric trees.

A vector becomes integers and is cut into equal parts; every part position has a codebook. Rows lie
in blocks of bounded size. For each block and part a metric tree is made once, middle-out: anchors
chosen farthest-first own the points nearest to them, each anchor's points become a tree of their
own, and neighbouring balls merge upwards. Balls hold their points' sum and number. An assignment
walks down with the codebook entries that may still be nearest for some point of the ball; once one
is left, the ball is its own, and its cached sum moves without a look at the points.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from corpusops.llm.bit_sliced import usable
from corpusops.operators.skew import with_group_value
from corpusops.session import durable, spread

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# rows of one block, and points that are not divided further
BLOCK_ROWS = 4096
LEAF = 16


def integers(values: np.ndarray, dims: int, scale: int = SCALE) -> np.ndarray:
    """(rows, dims) floor(scale * x); what squared distances in 64 bits can't hold is an error."""
    scaled = np.floor(scale * values.astype(np.float64))
    if len(scaled) and np.abs(scaled).max() > math.isqrt((1 << 62) // dims) // 2:
        raise ValueError(f"a component times {scale} is too large for squared distances in 64 bits")
    return scaled.astype(np.int64).reshape(-1, dims)


@dataclass
class Tree:
    """Balls over points in the order ``perm``; a ball's points are spans[i, 0]:spans[i, 1], its halves spans[i, 2:] (-1: a leaf)."""

    perm: np.ndarray
    spans: np.ndarray
    sums: np.ndarray
    balls: np.ndarray

    def packed(self) -> dict:
        return {"perm": self.perm.tobytes(), "spans": self.spans.tobytes(), "sums": self.sums.tobytes(), "balls": self.balls.tobytes()}

    @classmethod
    def of(cls, held: dict, width: int) -> Tree:
        whole = lambda name, kind, columns: np.frombuffer(held[name], kind).reshape(-1, columns)
        return cls(np.frombuffer(held["perm"], np.int32), whole("spans", np.int32, 4), whole("sums", np.int64, width), whole("balls", np.float64, width + 1))


def anchors(points: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor of each point, farthest-first; a point is looked at only where the triangle inequality leaves a choice."""
    owner = np.zeros(len(points), np.int64)
    pivots = [points[0]]
    far = np.sqrt(((points - pivots[0]) ** 2).sum(1).astype(float))
    while len(pivots) < wanted:
        at = int(far.argmax())
        if far[at] == 0:
            break
        new = points[at]
        apart = np.sqrt(((np.array(pivots) - new) ** 2).sum(1).astype(float))
        near = np.flatnonzero(far * 2 >= apart[owner])
        reach = np.sqrt(((points[near] - new) ** 2).sum(1).astype(float))
        won = reach < far[near]
        owner[near[won]], far[near[won]] = len(pivots), reach[won]
        pivots.append(new)
    return owner


def build_tree(points: np.ndarray) -> Tree:
    """The metric tree of integer points."""
    # ball: (members, left, right, centre, radius)
    balls: list[tuple] = []

    def ball(members: np.ndarray, left: int = -1, right: int = -1) -> int:
        inside = points[members]
        centre = inside.mean(0)
        balls.append((members, left, right, centre, math.sqrt(((inside - centre) ** 2).sum(1).max())))
        return len(balls) - 1

    def grown(members: np.ndarray) -> int:
        inside = points[members]
        if len(members) <= LEAF or (inside == inside[0]).all():
            return ball(members)
        owner = anchors(inside, math.isqrt(len(members) - 1) + 1)
        return merged([grown(members[owner == a]) for a in range(owner.max() + 1)])

    def merged(tops: list[int]) -> int:
        centres, radii = np.array([balls[t][3] for t in tops]), np.array([balls[t][4] for t in tops])
        size = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(-1)) + radii[:, None] + radii[None]
        np.fill_diagonal(size, np.inf)
        for _ in range(len(tops) - 1):
            a, b = divmod(int(size.argmin()), len(tops))
            tops[a] = ball(np.concatenate([balls[tops[a]][0], balls[tops[b]][0]]), tops[a], tops[b])
            centres[a], radii[a] = balls[tops[a]][3:]
            size[b], size[:, b] = np.inf, np.inf
            gone = np.isinf(size[a])
            size[a] = np.where(gone, np.inf, np.sqrt(((centres - centres[a]) ** 2).sum(-1)) + radii + radii[a])
            size[:, a] = size[a]
            last = a
        return tops[last]

    # of two halves the left one's members come first, so every ball is a run of the top's
    top = grown(np.arange(len(points)))
    start = np.zeros(len(balls), np.int64)
    for i in range(top, -1, -1):
        _, left, right, _, _ = balls[i]
        if left >= 0:
            start[left], start[right] = start[i], start[i] + len(balls[left][0])
    spans = np.array([(s, s + len(members), left, right) for s, (members, left, right, _, _) in zip(start, balls)], np.int32)
    return Tree(
        balls[top][0].astype(np.int32), spans, np.array([points[b[0]].sum(0) for b in balls]), np.array([np.append(b[3], b[4]) for b in balls])
    )


def assign(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each point's nearest entry (ties to the lower), and the sum and number of each entry's points."""
    ordered = points[tree.perm]
    found = np.zeros(len(points), np.int64)
    totals, counts = np.zeros_like(book), np.zeros(len(book), np.int64)
    stack = [(len(tree.spans) - 1, np.arange(len(book)))]
    while stack:
        i, entries = stack.pop()
        start, end, left, right = tree.spans[i]
        centre, radius = tree.balls[i, :-1], tree.balls[i, -1]
        away = np.sqrt(((book[entries] - centre) ** 2).sum(1))
        # farther than any point's way to the nearest, with room for rounding
        entries = entries[away <= away.min() + 2 * radius + 1e-9 * (1 + away.min() + radius)]
        if len(entries) == 1:
            found[start:end] = entries[0]
            totals[entries[0]] += tree.sums[i]
            counts[entries[0]] += end - start
        elif left < 0:
            inside = ordered[start:end]
            best = entries[((inside[:, None] - book[entries][None]) ** 2).sum(-1).argmin(1)]
            found[start:end] = best
            np.add.at(totals, best, inside)
            counts += np.bincount(best, minlength=len(book))
        else:
            stack += [(left, entries), (right, entries)]
    codes = np.empty(len(points), np.int64)
    codes[tree.perm] = found
    return codes, totals, counts


def _blocks(rows: DataFrame, dims: int, parts: int, scale: int) -> DataFrame:
    """(rows, vectors, trees): one row per block, its trees made once and read by every round."""
    width = dims // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(low, BLOCK_ROWS)
                if count + some.num_rows > BLOCK_ROWS:
                    yield block(held)
                    held, count = [], 0
                held.append(some)
                count += some.num_rows
        if count:
            yield block(held)

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        vectors = table.column("vector").combine_chunks()
        lengths = set(vectors.value_lengths().unique().to_pylist())
        if lengths != {dims}:
            raise ValueError(f"vector lengths {sorted(lengths)} where {dims} is wanted")
        whole = integers(vectors.flatten().to_numpy(zero_copy_only=False), dims, scale)
        trees = [build_tree(whole[:, p * width : (p + 1) * width]).packed() for p in range(parts)]
        kept = table.column("row").combine_chunks()
        lists = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
        return pa.RecordBatch.from_arrays([lists, pa.array([whole.tobytes()], pa.binary()), pa.array([trees], tree_type)], ["rows", "vectors", "trees"])

    tree_type = pa.list_(pa.struct([(name, pa.binary()) for name in ("perm", "spans", "sums", "balls")]))
    tree = StructType([StructField(name, BinaryType()) for name in ("perm", "spans", "sums", "balls")])
    schema = StructType([StructField("rows", ArrayType(rows.schema["row"].dataType)), StructField("vectors", BinaryType()), StructField("trees", ArrayType(tree))])
    return rows.mapInArrow(run, schema)


def _walk(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple]:
    """(block, vectors, assignments by part) of each block; ``books`` is (part, entry, place)."""
    parts, _, width = books.shape
    for batch in batches:
        for i in range(batch.num_rows):
            vectors = np.frombuffer(batch.column("vectors")[i].as_py(), np.int64).reshape(-1, parts * width)
            trees = batch.column("trees")[i].as_py()
            own = [assign(Tree.of(trees[p], width), vectors[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
            yield batch.column("rows")[i] if "rows" in batch.schema.names else None, vectors, own


def _refined(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the floored means of their points. Tasks send one row per part, entry and place."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, _, own in _walk(batches, books):
            for p, (_, total, count) in enumerate(own):
                totals[p] += total
                counts[p] += count
        p, e, at = np.nonzero(np.repeat(counts[:, :, None] > 0, width, 2))
        columns = [p, e, at, totals[p, e, at], counts[p, e]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "place", "total", "n"])

    sent = blocks.select("vectors", "trees").mapInArrow(run, "part long, entry long, place long, total long, n long")
    exact = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    out = books.copy()
    for r in sent.groupBy("part", "entry", "place").agg(exact, F.sum("n").alias("n")).collect():
        out[r.part, r.entry, r.place] = int(r.total) // r.n
    return out


def encoded(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that is neither null nor empty nor holds null or non-finite components.

    Codebooks start from the vectors of the ``entries`` smallest ids (null ids last, equal ids by
    vector) and are refined ``rounds`` times; with fewer vectors there are fewer entries. Repeated
    rows count each and are coded alike. ``label_error`` sums the errors of equal labels, nulls
    together. The vector of the smallest id gives the length: it must be divisible by ``parts``, and
    a vector of another length or with a component too large for exact sums ends the job. An empty
    table gives no rows. Other columns are not read.
    """
    own, held, named = (F.col(f"`{c}`") for c in (vec_id, vector, label))
    label_key = F.coalesce(F.concat(F.lit("="), named.cast("string")), F.lit("-"))
    fit = rows.select(F.struct(own.alias("vec_id"), label_key.alias("label_key")).alias("row"), held.alias("vector")).where(usable(F.col("vector")) & (F.size("vector") > 0))
    first = [r.vector for r in fit.orderBy(F.col("row.vec_id").asc_nulls_last(), "vector").limit(entries).collect()]
    dims = len(first[0]) if first else parts
    if dims % parts or any(len(v) != dims for v in first):
        raise ValueError(f"vectors of {sorted({len(v) for v in first})} components where one length divisible by {parts} is wanted")
    start = integers(np.array(first, np.float64).reshape(-1, dims), dims, scale)
    books = start.reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    blocks = durable(_blocks(spread(fit), dims, parts, scale))
    for _ in range(rounds if first else 0):
        books = _refined(blocks, books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, vectors, own in _walk(batches, books):
            codes = np.stack([c for c, _, _ in own], 1)
            near = np.concatenate([books[p][codes[:, p]] for p in range(parts)], 1)
            text = codes.astype(np.uint8).tobytes().hex()
            names = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            struct = kept.values
            yield pa.RecordBatch.from_arrays(
                [struct.field("vec_id"), struct.field("label_key"), pa.array(names, pa.string()), pa.array(((vectors - near) ** 2).sum(1))],
                ["vec_id", "label_key", "code", "error"],
            )

    schema = StructType([*fit.schema["row"].dataType.fields]).add("code", "string").add("error", "long")
    coded = durable(blocks.mapInArrow(code, schema))
    sums = durable(coded.groupBy("label_key").agg(F.count("*").alias("size"), F.sum("error").alias("label_error")))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return with_group_value(coded, sums, "label_key", "label_error").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
