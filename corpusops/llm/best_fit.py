"""Best-fit packing of token sequences under several capacities.

A piece of a document needs (tokens, 1 document, tokens squared for attention). All it takes to plan
is how many pieces of each length there are: at most ``max_tokens`` numbers, whatever the corpus.
The driver packs lengths in bulk, longest first, each into the open bins it fits best, and tasks
then give every piece its place by its rank among pieces of its length.
"""

from __future__ import annotations

import array
import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from corpusops.session import durable

MAX_TOKENS = 1024
# weights of tokens, documents and attention in the residual norm that chooses a bin
WEIGHTS = (1.0, 1e-4, 1e-4)
END_ID = 2
SPECIAL = "<|endoftext|>"
# words whose ids a task remembers
MEMO_WORDS = 150_000


class Encoder:
    """Ids of whole texts as packed little-endian 32-bit numbers.

    A pre-token never spans a single space between two characters that are not white space, and the
    space opens the one behind it. So a text with only such spaces is encoded word by word, and a
    word's ids are remembered. Other texts go through the tokenizer whole.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        pairs = (line.split() for line in open(ranks, "rb"))
        self.plain = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(k): int(v) for k, v in pairs}, special_tokens={}
        )
        self.vocabulary = vocabulary
        self.whole: Tokenizer | None = None
        self.words: dict[str, bytes] = {}
        self.odd = re.compile(r"^\s|\s\s|\s$")

    def _packed(self, text: str) -> bytes:
        return array.array("I", self.plain.encode_ordinary(text)).tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self._packed(" " + word)
            if len(self.words) < MEMO_WORDS:
                self.words[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            self.whole = self.whole or Tokenizer.from_file(self.vocabulary)
            return array.array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.odd.search(text):
            return self._packed(text)
        first, *rest = text.split(" ")
        word = self._word
        return self._packed(first) + b"".join([word(w) for w in rest])


def token_pieces(
    docs: DataFrame, vocabulary: str, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, keep_ids: bool = False
) -> DataFrame:
    """Token ids of each document, end id included, cut where they exceed ``max_tokens``.

    One row per piece: doc_id, piece, start, length, ids_crc32, and ``part`` and ``place``, which
    number the pieces of one length within the task. All pieces of a cut document but the first are
    full. ``keep_ids`` adds the ids themselves.
    """
    end = np.array([END_ID], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, place long" + (", ids array<long>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks, pattern)
        part = TaskContext.get().partitionId()
        placed = [0] * (max_tokens + 1)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                few = batch.slice(low, 512)
                rows = []
                for i, value in zip(few.column("doc_id").to_pylist(), few.column("text")):
                    ids = encoder.ids(value.as_py() or "") + end
                    total = len(ids) // 4
                    start, size = 0, total % max_tokens or max_tokens
                    for number in range(-(-total // max_tokens)):
                        own = ids[4 * start : 4 * (start + size)]
                        row = (i, number, start, size, zlib.crc32(own), part, placed[size])
                        rows.append((*row, np.frombuffer(own, "<u4").astype(np.int64)) if keep_ids else row)
                        placed[size] += 1
                        start, size = start + size, max_tokens
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int64())]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", "ids"][: len(columns)])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


@dataclass
class Plan:
    """Places of pieces by rank: for each row, ranks from ``rank`` on of pieces of ``length`` go
    ``each`` to a bin from ``first_bin`` on, behind ``filled`` tokens. Rows are in order of length and rank."""

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    first_bin: np.ndarray
    filled: np.ndarray
    bins: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of each piece."""
        span = int(max(self.rank.max(initial=0), rank.max(initial=0))) + 1
        row = np.searchsorted(self.length * span + self.rank, length * span + rank, "right") - 1
        nth = rank - self.rank[row]
        return self.first_bin[row] + nth // self.each[row], self.filled[row] + nth % self.each[row] * length


def pack_lengths(
    counts: dict[int, int], max_tokens: int = MAX_TOKENS, max_docs: int | None = None, max_cost: int | None = None, weights: tuple = WEIGHTS
) -> Plan:
    """Vector best-fit-decreasing over a histogram of lengths.

    A piece goes to the open bin whose residual capacities, after taking it, have the least weighted
    norm among those that it fits in every dimension. Bins in the same state are one entry.
    """
    limits = np.array([max_tokens, max_docs or max_tokens, max_cost or max_tokens**2], np.int64)
    scale = np.array(weights) / limits.astype(float) ** 2
    states: dict[tuple, list] = {}  # residual -> [(first bin, bins)]
    rows, bins = [], 0
    for length in sorted(counts, reverse=True):
        left, rank, need = counts[length], 0, np.array([length, 1, length * length], np.int64)
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities of an empty bin")
        while left:
            free = np.array(list(states), np.int64).reshape(-1, 3)
            fits = np.flatnonzero((free >= need).all(axis=1))
            if len(fits):
                after = free[fits] - need
                state = tuple(free[fits[np.argmin((after * after * scale).sum(axis=1))]].tolist())
            else:
                # the next full bins, and one for the rest
                state = tuple(limits.tolist())
                each = int(min(limits // need))
                states[state] = [(bins, -(-left // each))]
                bins += -(-left // each)
            each = int(min(np.array(state) // need))
            first, held = states[state].pop()
            full = min(held, left // each)
            taken = [(full, each)] if full else []
            if full < held and left - full * each:
                taken.append((1, min(each, left - full * each)))
            at = first
            for some, load in taken:
                rows.append((length, rank, load, at, max_tokens - state[0]))
                residual = tuple((np.array(state) - load * need).tolist())
                states.setdefault(residual, []).append((at, some))
                at, rank, left = at + some, rank + some * load, left - some * load
            if at < first + held:
                states[state].append((at, first + held - at))
            if not states[state]:
                del states[state]
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T, bins)


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, max_docs: int | None = None, max_cost: int | None = None, weights: tuple = WEIGHTS) -> DataFrame:
    """``token_pieces`` rows (a table, since it is read twice) with sequence_id and offset."""
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # lengths are at most max_tokens, so neither the histogram nor the plan grows with the corpus
    plan = pack_lengths({r["length"]: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, max_tokens, max_docs, max_cost, weights)
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("place", F.col("place") + F.col("before")).drop("before", "part")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bin_, offset = plan.places(batch.column("length").to_numpy(), batch.column("place").to_numpy())
            keep = [c for c in batch.schema.names if c != "place"]
            columns = [batch.column(c) for c in keep] + [pa.array(bin_, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "sequence_id", "offset"])

    fields = [f for f in ranked.schema.fields if f.name != "place"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"
    return ranked.mapInArrow(assign, schema)


def packed_documents(
    docs: DataFrame, vocabulary: str, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False, **capacities
) -> DataFrame:
    """Every document's pieces with their sequence and place in it.

    A null or empty text is its end id alone. Rows that repeat are packed each by itself, under
    whatever doc_id they have, null too; an empty table gives no rows. Other columns are not carried.
    """
    max_tokens = capacities.get("max_tokens", MAX_TOKENS)
    pieces = durable(token_pieces(docs, vocabulary, ranks, pattern, doc_id, text, max_tokens, keep_ids))
    return pack(pieces, **capacities)
