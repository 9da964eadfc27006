"""What two operators on repeated passages share: which anchors repeat, and taking words out.

An anchor is a k-word sequence that some window of ``window`` words selects (the least hash among
its k-word sequences). Equal windows select equal anchors, so a window that occurs in two documents
has an anchor that occurs in both: windows without a repeated anchor need no further look.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusops.llm.words import Texts, minimisers, mix, slices

LAST_ID = (1 << 63) - 1
# anchors that a map task gathers before it hands them over, and text behind one bucket of anchors
GATHER = 1 << 18
BUCKET_BYTES = 32 << 20


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, tag, text, rest): null ids count as larger than all others, null texts as empty.

    ``tag`` is a digest of the text. Id and tag are the key of all joins, so that what goes from one
    text stays in another with its id, and many texts under one id or none are spread; ``rest`` holds
    the other columns. All joins start from this one frame, so its shuffle is written once and read again.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(value).alias("tag"),
        value.alias("text"),
        F.struct(*rest).alias("rest"),
    )


def mark(tag, start, length):
    """A word range of a text as two longs: the text's tag, then 16 bits of length and 32 of start."""
    return np.stack(np.broadcast_arrays(tag, (np.asarray(length) << 32) | start), -1)


def spot(ids: np.ndarray, tags: np.ndarray, spread: int) -> np.ndarray:
    """The bucket of each text."""
    return (mix(ids.view(np.uint64) ^ mix(tags.view(np.uint64))) % np.uint64(spread)).astype(np.int64)


def of_bytes(data: bytes, columns: int = 1) -> np.ndarray:
    values = np.frombuffer(data, np.int64)
    return values if columns == 1 else values.reshape(-1, columns)


MARKS_SCHEMA = "bucket long, ids binary, found binary"


class Marks:
    """(id, mark) pairs that a task has found, handed over packed: one row per bucket of texts, whatever their number."""

    def __init__(self, spread: int):
        self.spread, self.ids, self.found, self.held = spread, [], [], 0

    def add(self, ids, found) -> Iterator[pa.RecordBatch]:
        self.ids.append(np.asarray(ids, np.int64))
        self.found.append(np.asarray(found, np.int64).reshape(-1, 2))
        self.held += len(ids)
        if self.held >= GATHER:
            yield from self.packed()

    def packed(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        ids, found = np.concatenate(self.ids), np.concatenate(self.found)
        self.ids, self.found, self.held = [], [], 0
        bucket = spot(ids, np.ascontiguousarray(found[:, 0]), self.spread)
        order = np.lexsort((found[:, 0], ids, bucket))
        ids, found, bucket = ids[order], found[order], bucket[order]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(ids))
        press = zstandard.ZstdCompressor(level=1).compress
        rows = [(int(bucket[a]), press(ids[a:b].tobytes()), press(found[a:b].tobytes())) for a, b in zip(cuts[:-1], cuts[1:])]
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["bucket", "ids", "found"])


def gathered(marks: DataFrame, buckets: int) -> DataFrame:
    """``Marks`` rows to (id, tag, marks), one row per text; ``marks`` are word ranges."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor().decompress
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append([of_bytes(unpress(b), c) for b, c in zip(blobs, (1, 2))])
        for bucket in list(held):
            parts = held.pop(bucket)
            ids, found = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.lexsort((found[:, 0], ids))
            ids, tags, found = ids[order], found[order, 0], found[order, 1]
            cuts = np.append(np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))), len(ids))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found))
            yield pa.RecordBatch.from_arrays([pa.array(ids[cuts[:-1]]), pa.array(tags[cuts[:-1]]), lists], ["id", "tag", "marks"])

    return marks.repartition(buckets, "bucket").mapInArrow(unpack, "id long, tag long, marks array<long>")


def bucket_count(spark, rows: DataFrame) -> tuple[int, int]:
    """Buckets so that each gets about ``BUCKET_BYTES`` of the text, and the number of rows."""
    size, n = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // BUCKET_BYTES)), n


def anchors_of(texts: Texts, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows' first words, the first word of each one's anchor, and that anchor's hash."""
    at = texts.windows(k)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    hashes = texts.window_hash(k, at)
    chosen = minimisers(hashes, texts.doc[at], window - k + 1)
    return texts.windows(window), at[chosen], hashes[chosen]


class Winners:
    """Equal keys meet: the smallest id goes on, the others have lost.

    A map task holds one of these, so of a key that many of its documents share one entry travels
    to the key's bucket. Losers travel too, dealt by document, for they need no further comparison.
    """

    def __init__(self, spread: int):
        self.spread = spread
        self.best: dict[bytes, list] = {}
        self.lost: list[tuple[int, list]] = []

    def __len__(self) -> int:
        return len(self.best) + len(self.lost)

    def add(self, key: bytes, i: int, bucket: int, m: list) -> None:
        held = self.best.get(key)
        if held is None:
            self.best[key] = [i, bucket, m]
        elif held[0] == i:
            held.append(m)
        elif held[0] < i:
            self.lost.append((i, m))
        else:
            self.lost.extend((held[0], x) for x in held[2:])
            self.best[key] = [i, bucket, m]

    def packed(self) -> pa.RecordBatch:
        """One row per bucket; keys hold no line breaks."""
        parts: dict[int, tuple] = {}
        for key, (i, bucket, *marks) in self.best.items():
            keys, ids, found, _, _ = parts.setdefault(bucket, ([], [], [], [], []))
            for m in marks:
                keys.append(key)
                ids.append(i)
                found.append(m)
        for i, m in self.lost:
            _, _, _, ids, found = parts.setdefault((i ^ m[0]) % self.spread, ([], [], [], [], []))
            ids.append(i)
            found.append(m)
        # short keys side by side compress far better here than by the shuffle's own codec
        press = zstandard.ZstdCompressor(level=1).compress
        rows = [(b, press(b"\n".join(t)), *(press(np.array(x, np.int64).tobytes()) for x in rest)) for b, (t, *rest) in parts.items()]
        columns = list(zip(*rows))
        self.best, self.lost = {}, []
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            ["bucket", "keys", "ids", "found", "lost_ids", "lost"],
        )


WINNERS_SCHEMA = "bucket long, keys binary, ids binary, found binary, lost_ids binary, lost binary"


def losers(batches: Iterator[pa.RecordBatch], spread: int) -> Iterator[pa.RecordBatch]:
    """``Marks`` of all entries of ``Winners`` rows but each key's smallest id."""
    held: dict[int, list] = {}
    marks = Marks(spread)
    unpress = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for bucket, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
            keys, ids, found, lost_ids, lost = map(unpress, blobs)
            if lost:
                yield from marks.add(of_bytes(lost_ids), of_bytes(lost, 2))
            if ids:
                held.setdefault(bucket, []).append((keys, ids, found))
    for bucket in list(held):
        parts = held.pop(bucket)
        keys = np.array([s for p in parts for s in p[0].split(b"\n")], object)
        ids = np.concatenate([np.frombuffer(p[1], np.int64) for p in parts])
        found = np.concatenate([of_bytes(p[2], 2) for p in parts])
        # depth-first order of the bucket's subtrees; a run of equal keys is a node of full depth
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
        keys, ids, found = keys[order], ids[order], found[order]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        least = np.repeat(np.minimum.reduceat(ids, head), np.diff(np.append(head, len(ids))))
        out = ids > least
        yield from marks.add(ids[out], found[out])
    yield from marks.packed()


def flags(counts: np.ndarray, listed: pa.Array, span: bool, window: int = 0) -> np.ndarray:
    """Which words the marks of each document name: whole ranges, or only the starts of windows in them."""
    first_word, total = counts, int(counts[-1])
    hit = np.zeros(total + 1, np.int64)
    for j, marks in enumerate(listed):
        if marks.is_valid:
            found = marks.values.to_numpy()
            first = first_word[j] + (found & 0xFFFFFFFF)
            size = found >> 32
            np.add.at(hit, first, 1)
            np.add.at(hit, first + size - (0 if span else window - 1), -1)
    return np.cumsum(hit)[:total] > 0


def repeated_anchors(rows: DataFrame, window: int, k: int, buckets: int) -> DataFrame:
    """(id, tag, anchors): the anchors of each text that occur under another id too.

    ``rows`` may have a column ``marks``: windows that start in these ranges take no part.

    Map tasks hand over one packed row per bucket, sorted by hash. Of an anchor that a task has met
    under several ids one entry goes to the anchor's bucket; the others are known to repeat and are
    dealt by text, so a passage in a third of all documents fills no bucket.
    """
    shift = np.uint64(64 - max(1, (buckets - 1).bit_length()))
    spread = 1 << max(1, (buckets - 1).bit_length())

    def packed(hashes: list, ids: list, tags: list) -> Iterator[pa.RecordBatch]:
        h, i, t = np.concatenate(hashes), np.concatenate(ids), np.concatenate(tags)
        order = np.lexsort((t, i, h))
        h, i, t = h[order], i[order], t[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (t[1:] != t[:-1])
        h, i, t = h[fresh], i[fresh], t[fresh]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(h)))
        # of several texts under one id all go on, as none tells whether the anchor repeats
        known = np.repeat(i[first] != i[first + size - 1], size)
        bucket = np.where(head | ~known, (h >> shift).astype(np.int64), spot(i, t, spread))
        order = np.argsort(bucket, kind="stable")
        h, i, t, bucket = h[order], i[order], t[order], bucket[order]
        state = (known.astype(np.uint8) + (known & ~head))[order]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(h))
        parts = [[int(bucket[a]), *(x[a:b].tobytes() for x in (h, i, t, state))] for a, b in zip(cuts[:-1], cuts[1:])]
        columns = list(zip(*parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["bucket", "h", "i", "t", "state"]
        )

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids, tags, held = [], [], [], 0
        for batch, texts in slices(batches, "text"):
            starts, anchor, h = anchors_of(texts, window, k)
            if "marks" in batch.schema.names:
                settled = flags(texts.first_word, batch.column("marks"), False, window)
                anchor, h = anchor[~settled[starts]], h[~settled[starts]]
            if not len(h):
                continue
            # neighbouring windows mostly choose the same anchor
            new = np.append(True, np.diff(anchor) != 0)
            doc = texts.doc[anchor[new]]
            hashes.append(h[new])
            ids.append(batch.column("id").to_numpy(zero_copy_only=False)[doc])
            tags.append(batch.column("tag").to_numpy(zero_copy_only=False)[doc])
            held += int(new.sum())
            if held >= GATHER:
                yield from packed(hashes, ids, tags)
                hashes, ids, tags, held = [], [], [], 0
        if held:
            yield from packed(hashes, ids, tags)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append(blobs)
        for bucket in list(held):
            blobs = held.pop(bucket)
            h = np.concatenate([np.frombuffer(b[0], np.uint64) for b in blobs])
            i, t = (np.concatenate([of_bytes(b[c]) for b in blobs]) for c in (1, 2))
            state = np.concatenate([np.frombuffer(b[3], np.uint8) for b in blobs])
            sure = state == 2
            out_h, out_i, out_t = [h[sure]], [i[sure]], [t[sure]]
            h, i, t, state = h[~sure], i[~sure], t[~sure], state[~sure]
            if len(h):
                order = np.lexsort((i, h))
                h, i, t, state = h[order], i[order], t[order], state[order]
                head = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                size = np.diff(np.append(head, len(h)))
                last = head + size - 1
                many = (i[head] != i[last]) | (np.maximum.reduceat(state, head) > 0)
                keep = np.repeat(many, size)
                out_h.append(h[keep])
                out_i.append(i[keep])
                out_t.append(t[keep])
            columns = [np.concatenate(out_i), np.concatenate(out_t), np.concatenate(out_h).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "tag", "anchor"])

    entries = rows.mapInArrow(select, "bucket long, h binary, i binary, t binary, state binary")
    pairs = entries.repartition(buckets, "bucket").mapInArrow(match, "id long, tag long, anchor long")
    return pairs.groupBy("id", "tag").agg(F.collect_set("anchor").alias("anchors"))


def member(values: np.ndarray, lists: list, doc: np.ndarray) -> np.ndarray:
    """Whether values[j] is in lists[doc[j]]."""
    sizes = np.array([len(x) for x in lists])
    owner = np.repeat(np.arange(len(lists)).astype(np.uint64), sizes)
    known = np.concatenate([np.asarray(x, np.int64) for x in lists]).view(np.uint64) if sizes.sum() else np.zeros(0, np.uint64)
    salt = np.uint64(0x9E3779B97F4A7C15)
    # a chance hit only adds a candidate, which the comparison of texts turns down
    return np.isin(values.view(np.uint64) + salt * doc.astype(np.uint64), known + salt * owner)


def without_words(rows: DataFrame, marks: DataFrame, keep_text: bool = True) -> DataFrame:
    """(rest, out): each row's other columns as a struct, and what is left of its text.

    ``marks`` is (id, tag, marks), one row per text: the word ranges that go. ``out.text`` is the text
    without the marked words and the white space behind each; ``out.kept_sha256`` is of the kept
    words joined by one space.
    """
    joined = rows.join(marks, ["id", "tag"], "left").select("id", "tag", "text", "rest", "marks")
    made = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())]
    made += [StructField("text", StringType())] if keep_text else []
    schema = StructType([joined.schema["rest"], StructField("out", StructType(made))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            n = batch.num_rows
            base = texts.first_word
            gone = flags(base, batch.column("marks"), span=True)
            kept, where, until = texts.joined(~gone)
            counts = np.concatenate([[0], np.cumsum(~gone)])[base]
            view = memoryview(kept)
            sha = []
            for j in range(n):
                a, b = counts[j], counts[j + 1]
                sha.append(hashlib.sha256(view[where[a] : until[b - 1]] if b > a else b"").hexdigest())
            words = np.diff(base)
            values = [pa.array(words), pa.array(words - np.diff(counts)), pa.array(sha, pa.string())]
            names = ["n_words", "n_removed", "kept_sha256"]
            if keep_text:
                drop = np.zeros(len(texts.data) + 1, np.int64)
                if gone.any():
                    following = np.append(texts.starts[1:], len(texts.data))
                    following = np.minimum(following, texts.offsets[1:][texts.doc])
                    drop[texts.starts[gone]] += 1
                    np.add.at(drop, following[gone], -1)
                keep = np.cumsum(drop)[:-1] == 0
                rest = texts.data[keep].tobytes()
                cuts = np.concatenate([[0], np.cumsum(keep)])[texts.offsets]
                values.append(pa.array([rest[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:])], pa.string()))
                names.append("text")
            out = pa.StructArray.from_arrays(values, names)
            yield pa.RecordBatch.from_arrays([batch.column("rest"), out], ["rest", "out"])

    return joined.mapInArrow(cut, schema)


def with_text(cut: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns of the input with the text that is left."""
    return cut.select(*[F.col("out.text").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in columns])

