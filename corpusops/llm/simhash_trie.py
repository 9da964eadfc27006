"""SimHash fingerprints, and all pairs of them within a Hamming budget by a binary trie self-join.

Fingerprints that differ in at most ``budget`` of 64 bits agree in one of ``budget`` + 1 blocks of
bits. For each block the bits are turned so that it leads; equal leading blocks are subtrees that
can hold linked pairs, and tasks traverse node pairs inside them. A pair of nodes carries the bits
it has differed in so far and is dropped once they exceed the budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusops.llm import near_copies
from corpusops.llm.components import components
from corpusops.llm.repeats import LAST_ID
from corpusops.llm.words import Texts, slices
from corpusops.session import durable, shuffles_go

SHINGLE_WORDS = 3
SEED = 42
BUDGET = 2
# bits in which fingerprints of likely near copies differ at most; a wider budget would leave the blocks few bits
NEAR_BUDGET = 3
WHITE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# fingerprints of one subtree that a task takes whole; a larger one is dealt as pairs of nodes SPLIT_BITS deeper
SUBTREE = 1 << 17
SPLIT_BITS = 8
# fingerprints traversed together, and node pairs and links alive at once
TOGETHER = 1 << 14
FRONTIER = 1 << 19


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, id, fp): the SimHash of each row's word shingles as a signed long.

    A-Z are lower-cased. A text with fewer words than a shingle is one shingle; one without words,
    empty or null, has fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch, texts in slices(batches, "text"):
            data = texts.data.copy()
            data[(data >= 65) & (data <= 90)] += 32
            texts = Texts(data, texts.offsets)
            joined, where, until = texts.joined()
            counts = np.diff(texts.first_word)
            at = texts.windows(words)
            short = np.flatnonzero((counts > 0) & (counts < words))
            first = np.concatenate([at, texts.first_word[short]])
            last = np.concatenate([at + words - 1, texts.first_word[short + 1] - 1])
            order = np.argsort(first, kind="stable")
            first, last = first[order], last[order]
            hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(where[first].tolist(), until[last].tolist())], np.uint64)
            held = np.bincount(texts.doc[first], minlength=batch.num_rows) if len(first) else np.zeros(batch.num_rows, int)
            out = np.zeros(batch.num_rows, np.uint64)
            full = np.flatnonzero(held)
            if len(full):
                bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
                cuts = np.concatenate([[0], np.cumsum(held[full])[:-1]])
                ones = np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
                out[full] = np.packbits(ones * 2 > held[full, None], axis=1).view(">u8").ravel()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("id"), pa.array(out.view(np.int64))], ["doc_id", "id", "fp"])

    ids = F.col(doc_id).cast("long")
    rows = docs.select(ids.alias("doc_id"), F.coalesce(ids, F.lit(LAST_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, id long, fp long")


def close_pairs(values: np.ndarray, pairs: np.ndarray, bit: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of values that differ in ``budget`` bits at most, by traversing node pairs.

    ``values`` is sorted within each node. ``pairs`` has a row (from, to, from, to, differing) for
    each pair of nodes; their bits above ``bit`` are settled. A node paired with itself yields each
    pair of its values once.
    """
    while len(pairs):
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            yield from close_pairs(values, pairs[:half], bit, budget)
            pairs = pairs[half:]
            continue
        a, a_end, b, b_end, differing = pairs.T
        single = (a_end - a == 1) & (b_end - b == 1)
        if single.any() or bit < 0:
            i, j = (a[single], b[single]) if bit >= 0 else (a, b)
            far = np.bitwise_count(values[i] ^ values[j]) > budget
            keep = ~far & (i != j)
            yield i[keep], j[keep]
            if bit < 0:
                return
            a, a_end, b, b_end, differing = pairs[~single].T
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        a_mid, b_mid = a_end - (ones[a_end] - ones[a]), b_end - (ones[b_end] - ones[b])
        same = (a == b) & (a_end == b_end)
        children = [
            np.stack([a, a_mid, b, b_mid, differing], 1),
            np.stack([a_mid, a_end, b_mid, b_end, differing], 1),
            np.stack([a, a_mid, b_mid, b_end, differing + 1], 1),
            np.stack([a_mid, a_end, b, b_mid, differing + 1], 1)[~same],
        ]
        pairs = np.concatenate(children)
        pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3]) & (pairs[:, 4] <= budget)]
        bit -= 1


def _roots(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place linked to each place."""
    root = np.arange(n)
    if links:
        i, j = np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])
        while True:
            before = root.copy()
            least = np.minimum(root[i], root[j])
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
            root = root[root]
            if (root == before).all():
                break
    return root


def links(nodes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(u, v) between the nodes (node, fp), fp distinct: enough links that all within the budget are connected.

    A task returns a tree over each set of nodes that its links connect, not every pair of it.
    """
    blocks = budget + 1
    edges = [round(64 * b / blocks) for b in range(blocks + 1)]

    def turn(b: int):
        # block b leads; shifts of a long take their amount modulo 64
        return F.shiftleft("fp", edges[b]).bitwiseOR(F.shiftrightunsigned("fp", 64 - edges[b])) if edges[b] else F.col("fp")

    def lead(b: int):
        return F.shiftrightunsigned(turn(b), 64 - (edges[b + 1] - edges[b]))

    parts = F.array(*[F.struct(F.lit(b).alias("part"), lead(b).alias("top"), turn(b).alias("value")) for b in range(blocks)])
    dealt = nodes.select("node", F.inline(parts))
    large = dealt.groupBy("part", "top").agg(F.count("*").alias("n")).where(F.col("n") > SUBTREE).select("part", "top", F.lit(True).alias("split"))
    masks = [m for m in range(1 << SPLIT_BITS) if bin(m).count("1") <= budget]
    widths = F.element_at(F.array(*[F.lit(edges[b + 1] - edges[b]) for b in range(blocks)]), F.col("part") + 1)
    sub = F.shiftrightunsigned(F.call_function("shiftleft", F.col("value"), widths), 64 - SPLIT_BITS)
    other = sub.bitwiseXOR(F.col("mask"))
    spread = (
        dealt.join(large, ["part", "top"], "left")
        .withColumn("mask", F.explode(F.when(F.col("split"), F.array(*[F.lit(m).cast("long") for m in masks])).otherwise(F.array(F.lit(-1).cast("long")))))
        .select(
            "node", "value", "part", "top",
            F.when(F.col("mask") < 0, -1).otherwise(F.least(sub, other)).alias("low"),
            F.when(F.col("mask") < 0, -1).otherwise(F.greatest(sub, other)).alias("high"),
        )
    )

    def together(values: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        head = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        end = np.append(head[1:], len(values))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for part in range(blocks):
            mine = keys[head, 0] == part
            width = edges[part + 1] - edges[part]
            whole = mine & ((keys[head, 2] == keys[head, 3]))
            pairs = np.stack([head, end, head, end, 0 * head], 1)[whole]
            found.extend(close_pairs(values, pairs[pairs[:, 1] - pairs[:, 0] > 1], 63 - width, budget))
            crossed = np.flatnonzero(mine & ~whole)
            if len(crossed):
                # the two nodes lie side by side, as their values are sorted
                shift = np.uint64(64 - width - SPLIT_BITS)
                low = (values >> shift) & np.uint64((1 << SPLIT_BITS) - 1)
                mids = np.array([h + int((low[h:e] == np.uint64(keys[h, 2])).sum()) for h, e in zip(head[crossed], end[crossed])])
                differing = np.bitwise_count((keys[head[crossed], 2] ^ keys[head[crossed], 3]).astype(np.uint64)).astype(np.int64)
                pairs = np.stack([head[crossed], mids, mids, end[crossed], differing], 1)
                pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
                found.extend(close_pairs(values, pairs, 63 - width - SPLIT_BITS, budget))
        root = _roots(len(values), found)
        moved = root != np.arange(len(values))
        return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], ["u", "v"])

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in ("part", "top", "low", "high", "node", "value")]
            held.append(np.stack(columns, 1))
            count += batch.num_rows
            if count >= TOGETHER:
                rows = np.concatenate(held)
                # the last group may go on in the next batch
                last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1))
                cut = last[-1] + 1 if len(last) else 0
                if cut:
                    yield together(rows[:cut, 5].copy().view(np.uint64), rows[:cut, 4], rows[:cut, :4])
                held, count = [rows[cut:]], len(rows) - cut
        if count:
            rows = np.concatenate(held)
            yield together(rows[:, 5].copy().view(np.uint64), rows[:, 4], rows[:, :4])

    keys = ["part", "top", "low", "high"]
    # signed order differs from bit order only in the leading bit, which a group shares
    sorted_groups = spread.repartition(*keys).sortWithinPartitions(*keys, "value")
    typed = sorted_groups.select(F.col("part").cast("long"), "top", "low", "high", "node", "value")
    return typed.mapInArrow(traverse, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, id, fp, component_id) per row: rows linked by chains of fingerprints within the budget share a component.

    ``component_id`` is the smallest id of the component. Equal fingerprints meet before any pair
    is sought, so copies are neither compared nor listed. A null id counts as the largest and comes
    back as null with its component's smallest id (the largest long if all are null). Repeated rows
    give repeated rows; an empty table gives none.
    """
    marked = durable(fingerprints(docs, doc_id, text, words))
    nodes = marked.groupBy("fp").agg(F.min("id").alias("node"))
    # an id may stand for several texts: its fingerprints are told apart by rank, links are between ids
    tree = components(links(nodes, budget))
    named = nodes.join(tree, F.col("node") == F.col("u"), "left").select("fp", F.coalesce("v", "node").alias("component_id"))
    return marked.join(named, "fp").select("doc_id", "id", "fp", "component_id")


def likely(rows: DataFrame, words: int, budget: int) -> DataFrame:
    """(u, v), written, of rows (node, text): at most a few links a node that join all whose fingerprints are within the budget."""
    marked = durable(fingerprints(rows, "node", "text", words))
    firsts = marked.groupBy("fp").agg(F.min("id").alias("node"))
    same = marked.join(firsts, "fp").where("id <> node").select(F.col("id").alias("u"), F.col("node").alias("v"))
    close = links(firsts, budget).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return durable(same.union(close).distinct())


def _gone(docs: DataFrame, doc_id: str, text: str, words: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """Written (row, own, node) of the documents that are told apart by their words, and (node), written, of those that go."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    ids = F.col(f"`{doc_id}`").cast("long")
    own = F.struct(ids.isNull().alias("none"), F.coalesce(ids, F.lit(LAST_ID)).alias("id"), F.md5(value).alias("digest"))
    # words without their white space: equal ones are copies, so only one of them is compared
    same = F.md5(F.trim(F.regexp_replace(F.translate(value, UPPER, LOWER), WHITE, " ")))
    keys = durable(docs.select(own.alias("own"), same.alias("same")))
    first = keys.groupBy("same").agg(F.min("own").alias("own")).select("own.*")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("own"))
    kept = named.join(first, [F.col(f"own.{c}") == first[c] for c in ("none", "id", "digest")], "left_semi")
    if keys.groupBy("own").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        kept = kept.dropDuplicates(["own"])
    rows = durable(kept.withColumn("node", F.monotonically_increasing_id()))
    texts = rows.select("node", F.coalesce(F.col(f"row.`{text}`"), F.lit("")).alias("text"))
    tree = durable(near_copies.groups(texts, words, linked=likely(texts, words, budget)))
    members = tree.union(tree.select("group", "group").distinct())
    ranked = durable(members.join(rows.select("node", "own"), "node"))
    stay = ranked.groupBy("group").agg(F.min("own").alias("own"))
    gone = ranked.join(stay.withColumnRenamed("own", "least"), "group").where("own <> least").select("node")
    return rows, durable(gone)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = near_copies.SHINGLE_WORDS, budget: int = NEAR_BUDGET) -> DataFrame:
    """One document of each group that chains of near copies link: the one with the smallest id, null ids last.

    The trie join links first; each of its links is held against the shingles of both texts. Fingerprints
    of near copies may differ in more bits than a trie join can allow for, so documents that it leaves in
    different groups meet by their shingles (``near_copies.groups``), and no link is lost.
    Case of A-Z and white space do not count; texts without words are copies of each other. An id may
    repeat or be null: documents are told apart by id and text, and of equal ids the smaller digest of
    the text stays. Rows that repeat both id and text count once.
    """
    with shuffles_go(docs.sparkSession):
        rows, gone = _gone(docs, doc_id, text, words, budget)
    return rows.join(gone, "node", "left_anti").select("row.*")
