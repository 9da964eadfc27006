"""Repeated passages by sparse suffix arrays.

Only suffixes at content-selected positions are kept: in each run of ``min_words`` words the place
whose ``ANCHOR_WORDS`` words have the least hash, so both copies of a passage keep the same ones.
Suffixes whose anchor repeats are dealt by it, sorted, and compared with their neighbours; the
longest match to the right and to the left bounds which passages an entry can share at all, and
matches are then extended left and right within those bounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusops.llm.repeats import (
    MARKS_SCHEMA,
    Marks,
    WINNERS_SCHEMA,
    Winners,
    anchors_of,
    bucket_count,
    gathered,
    keyed,
    mark,
    member,
    of_bytes,
    repeated_anchors,
    with_text,
    without_words,
)
from corpusops.llm.words import slices

MIN_WORDS = 50
ANCHOR_WORDS = 20
# an anchor with more than 1 / HEAVY_SHARE of all occurrences has its passages dealt one by one; fewer than HEAVY_SHARE have
HEAVY_SHARE = 2000
# documents that tell heavy anchors; they only decide how entries are dealt, never what is found
SAMPLE_DOCS = 4000
GATHER_ENTRIES = 1 << 15


def heavy_anchors(rows: DataFrame, n_docs: int, window: int, k: int) -> np.ndarray:
    """Hashes of the anchors that too many documents share for one group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            _, anchor, h = anchors_of(texts, window, k)
            h, n = np.unique(h[np.append(True, np.diff(anchor) != 0)] if len(h) else h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    every = max(1, n_docs // SAMPLE_DOCS)
    sample = rows.where(F.pmod(F.xxhash64("id", "tag"), F.lit(every)) == 0).select("text")
    counts = sample.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where((F.col("n") * HEAVY_SHARE > total) & (F.col("n") > 1)).select("h").collect()
    return np.array([r.h for r in found], np.int64).view(np.uint64)


def _common(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _neighbours(values: list[list], order: list[int]) -> list[int]:
    """The longest common prefix of each value with the one before or behind it in ``order``."""
    best = [0] * len(values)
    for p, q in zip(order, order[1:]):
        n = _common(values[p], values[q])
        best[p], best[q] = max(best[p], n), max(best[q], n)
    return best


def passages_lost(entries: list[tuple[list, list, int, int, list]], size: int) -> Iterator[tuple[int, list]]:
    """(id, mark) of the passages that an entry shares with a smaller id.

    An entry is (words left of the anchor, words from it on, least reach to the left, id, mark).
    """
    rights, lefts = [e[1] for e in entries], [e[0][::-1] for e in entries]
    right = _neighbours(rights, sorted(range(len(entries)), key=rights.__getitem__))
    left = _neighbours(lefts, sorted(range(len(entries)), key=lefts.__getitem__))
    # 128-bit digests of passages, which a group can hold many of
    least: dict[bytes, int] = {}
    seen = []
    for e, (before, behind, low, i, m) in enumerate(entries):
        own = []
        for reach in range(max(low, size - right[e]), min(len(before), left[e]) + 1):
            passage = hashlib.blake2b(b" ".join(before[len(before) - reach :] + behind[: size - reach]), digest_size=16).digest()
            least[passage] = min(least.get(passage, i), i)
            own.append((reach, passage))
        seen.append(own)
    for (before, _, _, i, m), own in zip(entries, seen):
        tag, start = m[0], m[1] & 0xFFFFFFFF
        run: list[int] = []
        for reach in [r for r, passage in own if least[passage] < i] + [-2]:
            if run and reach != run[-1] + 1:
                yield i, mark(tag, start + len(before) - run[-1], run[-1] - run[0] + size).tolist()
                run = []
            run.append(reach)


def _suffix(key: bytes) -> bytes:
    """The words of an entry from its anchor on."""
    context, high, _ = key.split(b"\t")
    return context.split(b" ", int(high))[-1]


def passage_marks(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, tag, marks): passages of ``min_words`` words that also start in a document with a smaller id."""
    buckets, n_docs = bucket_count(rows.sparkSession, rows)
    k = max(1, min(ANCHOR_WORDS, min_words // 2))
    spread = 1 << max(1, (buckets - 1).bit_length())
    shift = np.uint64(64 - (spread - 1).bit_length())
    heavy = heavy_anchors(rows, n_docs, min_words, k)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winners = Winners(spread)
        for batch, texts in slices(batches, "text"):
            windows, anchor, h = anchors_of(texts, min_words, k)
            keep = member(h, batch.column("anchors").to_pylist(), texts.doc[windows])
            windows, anchor, h = windows[keep], anchor[keep], h[keep]
            if not len(windows):
                continue
            # neighbouring windows with one anchor are one entry, unless the anchor is heavy
            head = np.append(True, (np.diff(anchor) != 0) | (np.diff(windows) != 1)) | np.isin(h, heavy)
            first = np.flatnonzero(head)
            last = np.append(first[1:], len(windows)) - 1
            start, end, at = windows[first], windows[last] + min_words, anchor[first]
            alone = np.isin(h[first], heavy)
            key = np.where(alone, texts.window_hash(min_words, start), h[first])
            reach = np.where(alone, 0, at - start)
            low = np.where(alone, 0, at - windows[last])
            doc = texts.doc[start]
            own = batch.column("id").to_numpy(zero_copy_only=False)[doc]
            tags = batch.column("tag").to_numpy(zero_copy_only=False)[doc]
            marks = mark(tags, start - texts.first_word[doc], end - start)
            joined, where, until = texts.joined()
            for a, b, high, least, i, bucket, m in zip(
                where[start].tolist(),
                until[end - 1].tolist(),
                reach.tolist(),
                low.tolist(),
                own.tolist(),
                (key >> shift).tolist(),
                marks.tolist(),
            ):
                winners.add(b"%s\t%d\t%d" % (joined[a:b], high, least), i, bucket, m)
                if len(winners) >= GATHER_ENTRIES:
                    yield winners.packed()
        if len(winners):
            yield winners.packed()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor().decompress
        held: dict[int, list] = {}
        marks = Marks(spread)
        for batch in batches:
            for bucket, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
                lost_ids, lost = map(unpress, blobs[3:])
                if lost:
                    yield from marks.add(of_bytes(lost_ids), of_bytes(lost, 2))
                # one bucket at a time is unpacked
                held.setdefault(bucket, []).append(blobs[:3])
        for bucket in list(held):
            best: dict[bytes, list] = {}
            out: list[tuple[int, list]] = []
            for blobs in held.pop(bucket):
                keys, ids, found = map(unpress, blobs)
                if not ids:
                    continue
                for key, i, m in zip(keys.split(b"\n"), of_bytes(ids).tolist(), of_bytes(found, 2).tolist()):
                    # the same words all round: only the smallest document need be compared further
                    kept = best.setdefault(key, [i])
                    if i < kept[0]:
                        out.extend((kept[0], x) for x in kept[1:])
                        kept[:] = [i]
                    kept.append(m) if i == kept[0] else out.append((i, m))
            # the bucket's sparse suffix array: places in the text, in the order of what follows them
            suffixes = sorted(best, key=_suffix)
            group: list[tuple] = []
            for number, key in enumerate(suffixes):
                words = _suffix(key).split(b" ")
                context, high, low = key.split(b"\t")
                i, *found = best.pop(key)
                group.extend((context.split(b" ", int(high))[: int(high)], words, int(low), i, m) for m in found)
                following = _suffix(suffixes[number + 1]).split(b" ", k)[:k] if number + 1 < len(suffixes) else None
                if following != words[:k]:
                    if len(group) > 1:
                        out.extend(passages_lost(group, min_words))
                    group = []
                    if len(out) >= GATHER_ENTRIES:
                        yield from marks.add(*zip(*out))
                        out = []
            if out:
                yield from marks.add(*zip(*out))
        yield from marks.packed()

    # all columns go into each pass, so that the joins share one shuffle of the texts
    anchors = repeated_anchors(rows, min_words, k, buckets)
    chosen = rows.join(anchors, ["id", "tag"]).select("id", "tag", "text", "rest", "anchors")
    dealt = chosen.mapInArrow(select, WINNERS_SCHEMA).repartition(buckets, "bucket")
    return gathered(dealt.mapInArrow(compare, MARKS_SCHEMA), buckets)


def drop_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, keep_text: bool = True
) -> DataFrame:
    """(rest, out) of ``without_words``: passages shared with a smaller document are taken out.

    A word goes when it is covered by ``min_words`` words in a row that also start in a document
    with a smaller id; passages are judged on the input. Null or empty texts have no words; shorter
    documents stay whole; repeats within one id stay; a null id is larger than any other, and rows
    with null ids are one document. Repeated rows each get the same result. An empty table gives no
    rows. Other columns ride along in ``rest``, whatever their names.
    """
    rows = keyed(docs, doc_id, text)
    return without_words(rows, passage_marks(rows, min_words), keep_text)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with shared passages cut out of their texts, white space elsewhere unchanged."""
    return with_text(drop_passages(docs, doc_id, text, min_words), docs.columns, text)
