"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text's encoding is the segmentation into pieces with the largest sum of scores (the unigram rule);
characters without a piece become bytes. Of segmentations with one sum any may be taken. Giant documents are split into chunks. A chunk yields a
transfer matrix in the max-plus semiring: from how many characters a piece reaches in from the left
to how many one reaches out to the right, the best score. Products of these matrices give each
boundary's state, and every chunk is then traced back by itself.

Inside a chunk no piece crosses from a character to a following word mark, so the stretches between
are independent, and equal words are encoded once.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusops.session import durable

MARK = "\u2581"
# no character of a text: half of a surrogate pair
STAND_IN = "\ud800"
CHUNK = 1 << 15
MEMO_WORDS = 200_000
NONE = -1e30
STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
BORDER = re.compile(f"(?<=[^{MARK}]){MARK}")


class Pieces:
    """The vocabulary of a model: scores by piece, and bytes by id."""

    def __init__(self, model: str):
        made = sentencepiece.SentencePieceProcessor(model_file=model)
        plain = [i for i in range(made.vocab_size()) if not (made.is_control(i) or made.is_unknown(i) or made.is_byte(i) or made.is_unused(i))]
        self.ids = {made.id_to_piece(i): i for i in plain}
        self.scores = {p: made.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(made.id_to_piece(i)[1:-1], 16): i for i in range(made.vocab_size()) if made.is_byte(i)}
        self.longest = max(map(len, self.ids))
        # below any segmentation that pieces can give
        self.fallback = min(self.scores.values()) - 10.0
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses into a following word, so words are not independent")
        self.text = [b""] * made.vocab_size()
        for p, i in self.ids.items():
            self.text[i] = p.replace(MARK, " ").encode()
        for b, i in self.bytes.items():
            self.text[i] = bytes([b])
        self.singles = {p for p in self.ids if len(p) == 1}
        self.finder = ahocorasick.Automaton()
        for p, score in self.scores.items():
            self.finder.add_word(p, (len(p), score))
        self.finder.make_automaton()
        self.memo: dict[str, bytes] = {}

    def steps(self, text: str) -> Iterable[tuple[int, tuple[int, float]]]:
        """(place of the last character, (characters, score)) of every piece in the text, by place."""
        found = self.finder.iter(text)
        if self.singles.issuperset(text):
            return found
        spelt = [
            (at, (1, self.fallback * len(c.encode("utf-8", "surrogatepass")))) for at, c in enumerate(text) if c not in self.singles
        ]
        return heapq.merge(found, spelt, key=itemgetter(0))

    def reach(self, text: str, entry: int, size: int) -> tuple[list[float], list[int]]:
        """Best score of each place from ``entry`` on, through pieces that start before ``size``, and the last piece's length."""
        best, last = [NONE] * (len(text) + 1), [0] * (len(text) + 1)
        best[entry] = 0.0
        # a place is settled before any piece that starts there ends
        for end, (n, score) in self.steps(text):
            at = end + 1 - n
            if at < size:
                total = best[at] + score
                if total > best[end + 1]:
                    best[end + 1], last[end + 1] = total, n
        return best, last

    def trace(self, text: str, last: list[int], entry: int, exit_: int) -> bytes:
        out: list[int] = []
        at = exit_
        while at > entry:
            piece = text[at - last[at] : at]
            own = self.ids.get(piece)
            out.extend([own] if own is not None else [self.bytes[b] for b in reversed(spelled(piece))])
            at -= last[at]
        return np.array(out[::-1], "<u4").tobytes()

    def word(self, text: str) -> bytes:
        """Ids of a stretch that no piece crosses."""
        held = self.memo.get(text)
        if held is None:
            held = self.trace(text, self.reach(text, 0, len(text))[1], 0, len(text))
            if len(self.memo) < MEMO_WORDS:
                self.memo[text] = held
        return held

    def cuts(self, text: str) -> list[str]:
        """Stretches that no piece crosses: each starts with its word marks."""
        return STRETCH.findall(text)

    def ends(self, text: str, size: int) -> tuple[int, int]:
        """Where the first stretch that starts inside a chunk begins, and the last."""
        spots = [m.start() for m in BORDER.finditer(text, 0, size)]
        return (spots[0], spots[-1]) if spots else (-1, -1)

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Transfer matrix of the chunk text[:size]; what follows shows how pieces may reach out.

        Stretches that lie wholly inside score the same for all states, so they are left out.
        """
        n = self.longest
        first, final = self.ends(text, size)
        out = np.full((n, n), NONE)
        tail = self.reach(text[final:], 0, size - final)[0] if first >= 0 else None
        for entry in range(min(n, size + 1)):
            if first < 0:
                best = self.reach(text, entry, size)[0]
                row = best[size : size + n]
            elif entry > first:
                continue
            else:
                head = self.reach(text[:first], entry, first)[0][first]
                row = [NONE if head <= NONE or x <= NONE else head + x for x in tail[size - final : size - final + n]]
            out[entry, : len(row)] = row
        return out

    def chunk_ids(self, text: str, size: int, entry: int, exit_: int) -> bytes:
        """Ids of the pieces that start in a chunk, given how its neighbours reach in and it reaches out."""
        first, final = self.ends(text, size)
        if first < 0:
            return self.trace(text, self.reach(text, entry, size)[1], entry, size + exit_)
        head = self.trace(text[:first], self.reach(text[:first], entry, first)[1], entry, first)
        tail = self.trace(text[final:], self.reach(text[final:], 0, size - final)[1], 0, size - final + exit_)
        return head + b"".join(map(self.word, self.cuts(text[first:final]))) + tail

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.word, self.cuts(text)))

    def decode(self, ids: bytes) -> str:
        text = self.text
        return b"".join([text[i] for i in np.frombuffer(ids, "<u4").tolist()])[1:].decode("utf-8")


def spelled(piece: str) -> bytes:
    """A character's bytes; STAND_IN takes the place of a mark that is part of the text."""
    return piece.replace(STAND_IN, MARK).encode("utf-8")


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NONE)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at each boundary of the best way through all chunks, from 0 to 0."""
    n = matrices[0].shape[0]
    forward = [np.where(np.arange(n) == 0, 0.0, NONE)]
    for m in matrices:
        forward.append(times(forward[-1][None, :], m)[0])
    states = [0]
    for before, m in zip(reversed(forward[:-1]), reversed(matrices)):
        states.append(int((before + m[:, states[-1]]).argmax()))
    return states[::-1]


def marked(text: str) -> str:
    """The text as pieces see it: a mark in front and for each space; a mark of its own becomes bytes."""
    return MARK + replaced(text) if text else ""


def replaced(text: str) -> str:
    return text.replace(MARK, STAND_IN).replace(" ", MARK)


def encoded(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc_id, ids, decoded): packed little-endian 32-bit ids of each row's text, and what they decode to.

    A null or empty text has no ids. Texts of any length are encoded whole, those over ``chunk``
    characters by the scan. Repeated rows are encoded each; null ids stay null; an empty table gives
    no rows; other columns are not carried.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), value.alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                some = batch.slice(low, 512)
                ids = [pieces.encode(marked(t.as_py())) for t in some.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(ids, pa.binary()), pa.array([pieces.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"]
                )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = Pieces(model).longest
        for batch in batches:
            for row, i, t in zip(*(c.to_pylist() for c in batch.columns)):
                # cut as the marked text is, which has one character more in front; the stand-in has no place in a column
                total = len(t) + 1
                for number, low in enumerate(range(0, total, chunk)):
                    part = t[max(0, low - 1) : low - 1 + chunk + ahead]
                    values = [row, i, number, min(chunk, total - low), part]
                    yield pa.RecordBatch.from_arrays([pa.array([v]) if v is not None else pa.array([v], pa.int64()) for v in values], ["row", "doc_id", "chunk", "size", "text"])

    def parts_of(batch: pa.RecordBatch) -> Iterator[str]:
        for number, t in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist()):
            yield replaced(t) if number else marked(t)

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            made = [pieces.matrix(t, n).tobytes() for t, n in zip(parts_of(batch), batch.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array(made, pa.binary())], ["row", "chunk", "matrix"])

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        made = [np.frombuffer(m, float) for m in table.column("matrix").to_pylist()]
        states = boundary_states([m.reshape(int(len(m) ** 0.5), -1) for m in made])
        return pa.table([table.column("row"), table.column("chunk"), pa.array(states[:-1]), pa.array(states[1:])], ["row", "chunk", "entry", "exit"])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("size", "entry", "exit")]
            ids = [pieces.chunk_ids(*x) for x in zip(parts_of(batch), *columns)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "chunk")), pa.array(ids, pa.binary())], ["row", "doc_id", "chunk", "ids"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            ids = [b"".join(x) for x in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([pieces.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"]
            )

    out = "doc_id long, ids binary, decoded string"
    short = rows.where(F.char_length("text") < chunk).select("doc_id", "text").mapInArrow(whole, out)
    chunks = durable(rows.where(F.char_length("text") >= chunk).mapInArrow(split, "row long, doc_id long, chunk long, size long, text string"))
    states = (
        chunks.select("row", "chunk", "size", "text").mapInArrow(transfer, "row long, chunk long, matrix binary")
        .groupBy("row").applyInArrow(combine, "row long, chunk long, entry long, exit long")
    )
    traced = chunks.join(states, ["row", "chunk"]).mapInArrow(back, "row long, doc_id long, chunk long, ids binary")
    parts = traced.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("c"))
    return short.union(parts.select("doc_id", F.col("c.ids").alias("parts")).mapInArrow(spell, out))
