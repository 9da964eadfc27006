"""Repeated word windows by prefix-partitioned suffix trees.

Every word position starts a suffix. Suffixes are cut at ``min_words`` words, which is as deep as
the question goes, and dealt by a prefix of variable length: two words, or as many more as it takes
until the prefix is not a frequent one, so that groups stay small. A task sorts a group's suffixes,
which lays its subtree out in depth-first order; runs of suffixes that agree to full depth are the
deep internal nodes. In each node the smallest document keeps its words.

Before that, blocks that a smaller document has word for word are settled as a whole, positions whose
window has no repeated anchor are left out (``repeats``), and of the suffixes that a task holds twice
only the smallest document's travels: the other has lost already.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusops.llm.repeats import (
    MARKS_SCHEMA,
    WINNERS_SCHEMA,
    Winners,
    anchors_of,
    bucket_count,
    flags,
    gathered,
    keyed,
    losers,
    mark,
    member,
    repeated_anchors,
    without_words,
)
from corpusops.llm.words import slices

MIN_WORDS = 13
ANCHOR_WORDS = 5
PREFIX_WORDS = (2, 4, 8)
# a prefix with more than 1 / HEAVY_SHARE of the suffixes is extended: fewer than HEAVY_SHARE are, per length
HEAVY_SHARE = 4000
# documents that tell frequent prefixes; they only decide how suffixes are dealt, never what is found
SAMPLE_DOCS = 2000
GATHER_ENTRIES = 1 << 16
BLOCK_WORDS = 32
LONGEST_BLOCK = 1 << 15


def frequent_prefixes(rows: DataFrame, n_docs: int, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hashes of the prefixes too frequent to be a group, by length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            for size in lengths:
                h, n = np.unique(texts.window_hash(size, texts.windows(size)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), size)), pa.array(h.view(np.int64)), pa.array(n)], ["size", "h", "n"]
                )

    every = max(1, n_docs // SAMPLE_DOCS)
    sample = rows.where(F.pmod(F.xxhash64("id", "tag"), F.lit(every)) == 0).select("text")
    counts = sample.mapInArrow(count, "size long, h long, n long").groupBy("size", "h").agg(F.sum("n").alias("n"))
    # the least share is taken from all positions of the sample, so the list has a fixed bound
    total = F.lit(sample.select(F.sum(F.size(F.split("text", "[ \t-\r]+")))).first()[0] or 0)
    found = counts.where((F.col("n") * HEAVY_SHARE > total) & (F.col("n") > 1)).select("size", "h").collect()
    return {size: np.array([r.h for r in found if r["size"] == size], np.int64).view(np.uint64) for size in lengths}


def block_marks(rows: DataFrame, window: int, buckets: int) -> DataFrame:
    """(id, mark): blocks of words that a smaller document has word for word.

    A block starts where the hash of three words is a multiple of ``BLOCK_WORDS``, so equal passages
    fall into equal blocks, and reaches ``window`` - 1 words into the next, so each window lies in
    the block it starts in. What copied documents share is settled here, block by block.
    """
    spread = 1 << max(1, (buckets - 1).bit_length())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winners = Winners(spread)
        for batch, texts in slices(batches, "text"):
            at = texts.windows(window)
            if not len(at):
                continue
            doc = texts.doc[at]
            cut = texts.window_hash(3, at) % np.uint64(BLOCK_WORDS) == 0
            cut |= np.append(True, doc[1:] != doc[:-1])
            # marks hold lengths of 16 bits
            cut |= (at - texts.first_word[doc]) % LONGEST_BLOCK == 0
            head = np.flatnonzero(cut)
            size = np.diff(np.append(head, len(at))) + window - 1
            first, doc = at[head], doc[head]
            own = batch.column("id").to_numpy(zero_copy_only=False)[doc]
            marks = mark(batch.column("tag").to_numpy(zero_copy_only=False)[doc], first - texts.first_word[doc], size)
            joined, where, until = texts.joined()
            for a, b, i, m in zip(where[first].tolist(), until[first + size - 1].tolist(), own.tolist(), marks.tolist()):
                digest = hashlib.blake2b(joined[a:b], digest_size=15).digest()
                winners.add(base64.b64encode(digest), i, int.from_bytes(digest[:4]) % spread, m)
                if len(winners) >= GATHER_ENTRIES:
                    yield winners.packed()
        if len(winners):
            yield winners.packed()

    dealt = rows.select("id", "tag", "text").mapInArrow(blocks, WINNERS_SCHEMA).repartition(buckets, "bucket")
    return dealt.mapInArrow(partial(losers, spread=spread), MARKS_SCHEMA)


def repeat_marks(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, tag, marks): windows of ``min_words`` words that also start in a document with a smaller id."""
    buckets, n_docs = bucket_count(rows.sparkSession, rows)
    k = min(ANCHOR_WORDS, min_words)
    lengths = tuple(x for x in PREFIX_WORDS if x < min_words)
    heavy = frequent_prefixes(rows, n_docs, lengths)
    spread = 1 << max(1, (buckets - 1).bit_length())
    shift = np.uint64(64 - (spread - 1).bit_length())

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winners = Winners(spread)
        for batch, texts in slices(batches, "text"):
            windows, _, h = anchors_of(texts, min_words, k)
            settled = flags(texts.first_word, batch.column("marks"), False, min_words)
            windows, h = windows[~settled[windows]], h[~settled[windows]]
            at = windows[member(h, batch.column("anchors").to_pylist(), texts.doc[windows])]
            if not len(at):
                continue
            key = texts.window_hash(min_words, at)
            for size in reversed(lengths):
                shorter = texts.window_hash(size, at)
                key = np.where(np.isin(shorter, heavy[size]), key, shorter)
            doc = texts.doc[at]
            own = batch.column("id").to_numpy(zero_copy_only=False)[doc]
            marks = mark(batch.column("tag").to_numpy(zero_copy_only=False)[doc], at - texts.first_word[doc], min_words)
            joined, where, until = texts.joined()
            for a, b, i, bucket, m in zip(
                where[at].tolist(), until[at + min_words - 1].tolist(), own.tolist(), (key >> shift).tolist(), marks.tolist()
            ):
                winners.add(joined[a:b], i, bucket, m)
                if len(winners) >= GATHER_ENTRIES:
                    yield winners.packed()
        if len(winners):
            yield winners.packed()

    # all columns go into each pass, so that the joins share one shuffle of the texts
    settled = block_marks(rows, min_words, buckets)
    once = rows.join(gathered(settled, buckets), ["id", "tag"], "left")
    anchors = repeated_anchors(once.select("id", "tag", "text", "rest", "marks"), min_words, k, buckets)
    chosen = once.join(anchors, ["id", "tag"]).select("id", "tag", "text", "rest", "marks", "anchors")
    dealt = chosen.mapInArrow(suffixes, WINNERS_SCHEMA).repartition(buckets, "bucket")
    return gathered(settled.union(dealt.mapInArrow(partial(losers, spread=spread), MARKS_SCHEMA)), buckets)


def drop_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, keep_text: bool = True
) -> DataFrame:
    """(rest, out) of ``without_words``: words that a window shares with a smaller document are taken out.

    A word goes when it is covered by a window of ``min_words`` words that also starts in a document
    with a smaller id; windows are judged on the input. Null or empty texts have no words; documents
    shorter than a window stay whole; repeats within one id stay; a null id is larger than any other,
    and rows with null ids are one document. Repeated rows each get the same result. An empty table
    gives no rows. Other columns ride along in ``rest``, whatever their names.
    """
    rows = keyed(docs, doc_id, text)
    return without_words(rows, repeat_marks(rows, min_words), keep_text)
