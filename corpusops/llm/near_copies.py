"""Near copies by the exact Jaccard similarity of word shingles.

Two sets of n and m shingles that reach the similarity share one among the first n - ceil(s n) + 1
of each, in any common order (prefix filter), and the places of the first shared one bound what they
share in all. Shingles found in many documents come last in the order, so groups of one shingle stay
small; the order decides only what is compared. The texts of each pair decide on its link.

Only groups are asked for, so a large group of one shingle is first compared along a chain of
neighbours. What that links is one group of documents from then on, with its least node as its
representative; afterwards only documents of different groups are compared, all of them.

Texts that share some shingles by chance make candidates that grow faster than the texts. One bit per
shingle turns nearly all of them down before any text travels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusops.llm.components import components
from corpusops.llm.words import Texts, slices, texts_of
from corpusops.operators.set_bits import parity_bits, plausible
from corpusops.session import durable

SHINGLE_WORDS = 5
# least similarity of a link, as a fraction
SHARED, OF = 4, 5
# a shingle is common if of one document in SAMPLE so many, and this share, hold it: of shingles of one
# text there are at most 1 / COMMON_SHARE times as many; a bitmap of fixed size, made by executors, tells which
SAMPLE, COMMON, COMMON_SHARE, BITMAP = 16, 4, 0.001, 1 << 24
# entries up to which a group of one shingle is compared whole in the first round
WHOLE = 16
PAIR, OPEN = 0, 1
# entries whose groups are compared together
TOGETHER = 1 << 18


def lowered(texts: Texts) -> Texts:
    data = texts.data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    return Texts(data, texts.offsets)


def shingles(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each distinct shingle, by document and hash; a text with fewer words is one shingle."""
    counts = np.diff(texts.first_word)
    at = texts.windows(words)
    short = np.flatnonzero((counts > 0) & (counts < words))
    hashes = texts.window_hash(words, at)
    for j in short:
        first, last = texts.first_word[j : j + 2]
        hashes = np.append(hashes, texts.window_hash(int(last - first), np.array([first])))
    doc = np.concatenate([texts.doc[at], short])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[fresh], hashes[fresh]


def shingle_set(text: str, words: int) -> set[bytes]:
    texts = lowered(texts_of(pa.array([text])))
    joined, where, until = texts.joined()
    where, until = where.tolist(), until.tolist()
    if 0 < len(where) < words:
        return {joined[: until[-1]]}
    return {joined[a:b] for a, b in zip(where, until[words - 1 :])}


def similar(a: set[bytes], b: set[bytes]) -> bool:
    return OF * len(a & b) >= SHARED * len(a | b)


def common_shingles(rows: DataFrame, words: int) -> np.ndarray:
    """One bit per shingle hash modulo ``BITMAP``: whether it counts as common."""

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(shingles(lowered(texts), words)[1].view(np.int64))], ["shingle"])

    sample = rows.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0)
    least = max(COMMON, int(np.ceil(COMMON_SHARE * sample.count())))
    often = sample.select("text").mapInArrow(every, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    # numbers from 1 on, as the bitmap functions count
    spot = often.select((F.pmod("shingle", F.lit(BITMAP)) + 1).alias("spot"))
    parts = spot.groupBy(F.bitmap_bucket_number("spot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    packed = np.zeros(BITMAP // 8, np.uint8)
    for r in parts.collect():
        packed[(r.part - 1) * len(r.bits) : r.part * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return packed


def is_common(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Each hash's bit of ``common_shingles``, read where it lies: the bitmap is not unpacked in every task."""
    spot = (hashes % np.uint64(BITMAP)).astype(np.int64)
    return (packed[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1


def grouped(rows: DataFrame, words: int = SHINGLE_WORDS, whole: int = WHOLE) -> DataFrame:
    """What groups of one shingle tell of rows (node, text), as (kind, u, v, shingle, size, place).

    ``PAIR`` is a candidate (u, v); of groups of up to ``whole`` entries they are all there, of larger
    ones a chain of neighbours, and all their entries are given as ``OPEN`` with the node in ``u``.
    Texts without words have none.
    """
    packed = common_shingles(rows, words)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            doc, hashes = shingles(lowered(texts), words)
            order = np.lexsort((hashes, is_common(packed, hashes), doc))
            hashes = hashes[order]
            sizes = np.bincount(doc, minlength=batch.num_rows)
            place = np.arange(len(doc)) - (np.cumsum(sizes) - sizes)[doc]
            size = sizes[doc]
            head = place < size - -(-SHARED * size // OF) + 1
            node = batch.column("node").to_numpy()[doc[head]]
            columns = [hashes[head].view(np.int64), node, size[head].astype(np.int32), place[head].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "node", "size", "place"])

    def together(key: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(first, len(key)))
        end = np.repeat(np.append(first[1:], len(key)), count)
        large = np.repeat(count > whole, count)
        if large.any():
            yield _told(OPEN, node[large], node[large], key[large], size[large], place[large])
        i, ahead = np.arange(len(key)), 1
        while len(i := i[i + ahead < end[i]]):
            yield from _likely(node, size, place, i, i + ahead)
            i, ahead = i[~large[i]], ahead + 1

    entries = rows.select("node", "text").mapInArrow(prefixes, "shingle long, node long, size int, place int")
    dealt = entries.repartition("shingle").sortWithinPartitions("shingle", "size", "node")
    return dealt.mapInArrow(_by_group(together, ("node", "size", "place")), TOLD)


EVERY = 1 << 62
TOLD = "kind int, u long, v long, shingle long, size int, place int"


def _told(kind: int, u: np.ndarray, v: np.ndarray, shingle: np.ndarray, size: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    columns = [np.full(len(u), kind, np.int32), np.maximum(u, v), np.minimum(u, v), shingle, size.astype(np.int32), place.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "u", "v", "shingle", "size", "place"])


def _likely(node: np.ndarray, size: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The pairs of entries i and j whose documents can be similar if this shingle is the first they share.

    A pair is met at the first one too, so what this turns down elsewhere is not lost.
    """
    near = (SHARED + OF) * np.minimum(size[i] - place[i], size[j] - place[j]) >= SHARED * (size[i] + size[j])
    if near.any():
        none = np.zeros(int(near.sum()), np.int64)
        yield _told(PAIR, node[i[near]], node[j[near]], none, none, none)


def _by_group(together: Callable, values: tuple[str, ...]) -> Callable:
    """Hand rows sorted by shingle over, some ``TOGETHER`` at a time and a group never in two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(c).to_numpy() for c in ("shingle", *values)])
            count += batch.num_rows
            if count >= TOGETHER:
                columns = [np.concatenate(c) for c in zip(*held)]
                # the last group may go on in the next batch
                cut = int(np.searchsorted(columns[0], columns[0][-1]))
                yield from together(*(c[:cut] for c in columns)) if cut else ()
                held, count = [[c[cut:] for c in columns]], count - cut
        if count:
            yield from together(*(np.concatenate(c) for c in zip(*held)))

    return run


def signatures(rows: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(node, size, bits) of rows (node, text): the number of shingles and their ``parity_bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            doc, hashes = shingles(lowered(texts), words)
            sizes = np.bincount(doc, minlength=batch.num_rows).astype(np.int32)
            columns = [batch.column("node"), pa.array(sizes), parity_bits(doc, hashes, batch.num_rows)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "size", "bits"])

    return rows.select("node", "text").mapInArrow(run, "node long, size int, bits binary")


def comparable(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (u, v) that may have the similarity by their written ``signatures``."""
    a, b = bits.toDF("u", "n", "a"), bits.toDF("v", "m", "b")
    return plausible(pairs.join(b, "v").join(a, "u"), "u", "v", SHARED, OF)


def _labelled(open_: DataFrame, tree: DataFrame) -> DataFrame:
    """``OPEN`` entries with their group in ``tree`` (node, group)."""
    joined = open_.select(F.col("u").alias("node"), "shingle", "size", "place").join(tree, "node", "left")
    return joined.withColumn("group", F.coalesce("group", "node"))


def across(open_: DataFrame, tree: DataFrame) -> DataFrame:
    """(u, v) of ``OPEN`` entries with one shingle in different groups of ``tree`` (node, group) that can be similar."""
    held = durable(_labelled(open_, tree))
    # where all are of one group by now, nothing is left to compare, however many they are
    mixed = held.groupBy("shingle").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("shingle")
    rest = held.join(mixed, "shingle")

    def together(key: np.ndarray, group: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        end = np.repeat(np.append(first[1:], len(key)), np.diff(np.append(first, len(key))))
        inner = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
        following = np.repeat(np.append(inner[1:], len(key)), np.diff(np.append(inner, len(key))))
        # each entry with all entries of the groups behind its own
        i, ahead = np.arange(len(key)), 0
        while len(i := i[following[i] + ahead < end[i]]):
            yield from _likely(node, size, place, i, following[i] + ahead)
            ahead += 1

    dealt = rest.repartition("shingle").sortWithinPartitions("shingle", "group", "node")
    # a shingle's rows stay together; groups within it are told apart here
    found = dealt.mapInArrow(_by_group(together, ("group", "node", "size", "place")), TOLD)
    return found.select("u", "v").distinct()


def groups(rows: DataFrame, words: int = SHINGLE_WORDS, whole: int = WHOLE, linked: DataFrame | None = None) -> DataFrame:
    """(node, group) of rows (node, text) that chains of similar texts link to a smaller node.

    ``linked`` may name written pairs (u, v) that another join finds likely: they are checked first,
    and what they link is not compared again.
    """
    told = durable(grouped(rows, words, whole))
    bits = durable(signatures(rows, words))
    pairs = durable(comparable(told.where(F.col("kind") == PAIR).select("u", "v").distinct(), bits))
    named = pairs.select("u").union(pairs.select("v"))
    if linked is not None:
        named = named.union(linked.select("u")).union(linked.select("v"))
    texts = packed_texts(rows, named)
    found, apart = None, pairs
    if linked is not None:
        found = durable(components(durable(verified(linked, texts, words))))
        ours, theirs = found.toDF("u", "_a"), found.toDF("v", "_b")
        named_pairs = pairs.join(ours, "u", "left").join(theirs, "v", "left")
        apart = durable(named_pairs.where(F.coalesce("_a", "u") != F.coalesce("_b", "v")).select("u", "v"))
    near = durable(verified(apart, texts, words))
    tree = durable(components(near if found is None else found.union(near)).toDF("node", "group"))
    open_ = told.where(F.col("kind") == OPEN)
    if open_.isEmpty():
        return tree
    rest = durable(comparable(across(open_, tree), bits).join(pairs, ["u", "v"], "left_anti"))
    if rest.isEmpty():
        return tree
    texts = packed_texts(rows, rest.select("u").union(rest.select("v")))
    return components(tree.toDF("u", "v").union(verified(rest, texts, words))).toDF("node", "group")


def links(rows: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(u, v): all pairs of rows (node, text) whose shingles have the similarity; their number grows with the square of a group's size."""
    pairs = durable(grouped(rows, words, EVERY).where(F.col("kind") == PAIR).select("u", "v").distinct())
    return verified(pairs, packed_texts(rows, pairs.select("u").union(pairs.select("v"))), words)


def packed_texts(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text): the texts of ``nodes``, compressed and written."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=9)
        for batch in batches:
            packed = [press.compress(t.as_buffer()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], ["node", "text"])

    # written, so that its size is known: where it is small, no text is dealt out
    ends = durable(nodes.toDF("node").distinct())
    return durable(rows.select("node", "text").join(ends, "node", "left_semi").mapInArrow(pack, "node long, text binary"))


def verified(pairs: DataFrame, texts: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """The written pairs (u, v) whose shingles have the similarity, by their ``packed_texts``."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        read = lambda packed: shingle_set(unpack.decompress(packed.as_buffer()).decode(), words)
        for batch in batches:
            keep, last, ours = [], None, set()
            for u, a, b in zip(batch.column("u").to_pylist(), batch.column("a"), batch.column("b")):
                if u != last:
                    last, ours = u, read(a)
                keep.append(similar(ours, read(b)))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    a, b = texts.select(F.col("node").alias("u"), F.col("text").alias("a")), texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    return pairs.join(b, "v").join(a, "u").select("u", "v", "a", "b").mapInArrow(verify, "u long, v long")
