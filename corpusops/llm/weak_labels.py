"""A quality classifier without labels.

Overlapping heuristics vote clean, junk or nothing on every document. Expectation-maximisation over
the counts of vote patterns, taken from all documents, estimates how accurate each heuristic is, and
so the chance of junk for each pattern. These posteriors train a linear scorer over hashed features
of words, which then scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from corpusops.llm.words import WORD_BASE, Texts, mix, range_hash, slices

ABSTAIN, CLEAN, JUNK = 0, 1, 2
DIMENSIONS = 1 << 14
# distinct texts that train the scorer, at most so many of either kind
FIT_DOCS = 1024
EM_ROUNDS = 200
# names of the votes, in the order of their places in a pattern
LABELLERS = ("symbols", "capitals", "echoes", "variety", "tails", "word_length", "letters", "sentences")
# the labellers that look for one kind of junk: stray symbols and shouting, and words over and over
KINDS = ((0, 1, 4, 6), (2, 3))
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"!#$%&*+<=>@\\^_`|~{}[]/", np.uint8))
UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
LETTER = UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)


def _per_doc(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[cuts[1:]] - sums[cuts[:-1]]).astype(float)


def votes(texts: Texts) -> np.ndarray:
    """One vote per document and labeller."""
    data, cuts, words = texts.data, texts.offsets, texts.first_word
    n_words = np.diff(words).astype(float)
    starts, ends = texts.starts, texts.ends
    word_bytes = _per_doc((ends - starts), words)
    letters = _per_doc(LETTER[data], cuts)
    share = lambda a, b: a / np.maximum(b, 1)
    symbols = share(_per_doc(SYMBOLS[data], cuts), word_bytes)
    capitals = share(_per_doc(UPPER[data], cuts), letters)
    h = texts.word_hash
    echo = np.zeros(len(h), bool)
    echo[1:] = (h[1:] == h[:-1]) & (texts.doc[1:] == texts.doc[:-1])
    echoes = share(_per_doc(echo, words), n_words)
    order = np.lexsort((h, texts.doc))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (texts.doc[1:] != texts.doc[:-1])
    # a text of n words has some n ** 0.85 distinct ones or more
    variety = share(_per_doc(fresh, words), n_words**0.85)
    tails = share(_per_doc(SYMBOLS[data[ends - 1]] if len(ends) else np.zeros(0, bool), words), n_words)
    stops = share(_per_doc(np.isin(data[ends - 1], np.frombuffer(b".,;:?", np.uint8)) if len(ends) else np.zeros(0, bool), words), n_words)
    length = share(word_bytes, n_words)
    solid = share(letters, word_bytes)

    def vote(junk: np.ndarray, clean: np.ndarray, enough: int) -> np.ndarray:
        return np.where(n_words < enough, ABSTAIN, np.where(junk, JUNK, np.where(clean, CLEAN, ABSTAIN)))

    never = np.zeros(len(n_words), bool)
    return np.stack(
        [
            # the lack of one kind of junk speaks for nothing, so these vote junk or not at all
            vote(symbols > 0.04, never, 1),
            vote(capitals > 0.5, never, 3),
            vote(echoes > 0.25, echoes < 0.08, 3),
            vote(variety < 0.45, variety > 0.75, 20),
            vote(tails > 0.25, never, 2),
            vote((length < 2) | (length > 16), (length > 3) & (length < 12), 3),
            vote(solid < 0.8, never, 1),
            vote(stops < 0.01, stops > 0.03, 40),
        ],
        1,
    ).astype(np.int64)


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Chance of junk per pattern, and each labeller's chance of each vote, for clean texts and each kind of junk.

    The truth is clean or one kind of junk, since a heuristic that looks for one kind is blind to the
    others; given the truth labellers are independent. A kind starts from the votes of the labellers
    that look for it, so classes keep their names. What no labeller calls junk is clean throughout.
    """
    quiet = ~(patterns == JUNK).any(1)
    table = np.stack([patterns == v for v in (ABSTAIN, CLEAN, JUNK)], 2).astype(float)
    said = np.stack([(patterns[:, list(kind)] == JUNK).sum(1) for kind in KINDS], 1).astype(float)
    truth = np.concatenate([np.where(said.sum(1, keepdims=True) > 0, 0.1, 0.98), said + 0.01], 1)
    truth[:, 1:] *= ((1 - truth[:, 0]) / truth[:, 1:].sum(1))[:, None]
    for _ in range(rounds):
        before = truth
        mass = counts @ truth + 1
        # one count of each vote keeps chances off zero
        given = (np.einsum("pk,plv->klv", counts[:, None] * truth, table) + 1) / (mass + 2)[:, None, None]
        log = np.einsum("plv,klv->pk", table, np.log(given)) + np.log(mass / mass.sum())
        truth = np.exp(log - log.max(1, keepdims=True))
        truth /= truth.sum(1, keepdims=True)
        truth[quiet] = np.eye(1, truth.shape[1])
        if len(truth) == 0 or np.abs(truth - before).max() < 1e-9:
            break
    return 1 - truth[:, 0], given


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) indexes: for each word its hash, its shape, its last two bytes, and whether it echoes the word before."""
    h, data = texts.word_hash, texts.data
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = texts.starts, texts.ends
    kind = np.select([UPPER, LETTER, SYMBOLS], [1, 2, 3], 0).astype(np.uint64)
    first, last = data[starts], data[ends - 1]
    middle = data[(starts + ends) // 2]
    shape = kind[first] * np.uint64(16) + kind[middle] * np.uint64(4) + kind[last]
    tail = last.astype(np.uint64) * np.uint64(256) + data[np.maximum(ends - 2, starts)]
    echo = np.zeros(len(h), np.uint64)
    echo[1:] = (h[1:] == h[:-1]) & (texts.doc[1:] == texts.doc[:-1])
    every = np.stack([h, shape, tail, echo], 1) ^ np.array([0, 1, 2, 3], np.uint64) * np.uint64(0xA24BAED4963EE407)
    hashed = (mix(every) % np.uint64(DIMENSIONS)).astype(np.int64)
    return np.repeat(np.arange(len(h)), 4), hashed.ravel()


def fit_scorer(docs: list[tuple[np.ndarray, np.ndarray]], junk: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic weights over feature shares, for soft labels; full gradients with momentum scaled per weight.

    A document is its features and how often it has each.
    """
    index = np.concatenate([d for d, _ in docs]) if docs else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(docs)), [len(d) for d, _ in docs])
    value = np.concatenate([n / max(1, n.sum()) for _, n in docs]) if docs else np.zeros(0)
    weights, bias = np.zeros(DIMENSIONS), 0.0
    m, v = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights[index] * value, len(junk)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - junk) / max(1, len(junk))
        gradient = np.append(np.bincount(index, error[row] * value, DIMENSIONS) + decay * weights / max(1, len(junk)), error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = 0.5 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        weights, bias = weights - step[:-1], bias - step[-1]
    return weights, bias


def _rows(docs: DataFrame, text: str) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.struct(*rest).alias("rest"))


def scored(docs: DataFrame, text: str = "text", fit_docs: int = FIT_DOCS) -> DataFrame:
    """(rest, text, pattern, clean): every row with its votes, as digits in base three, and its chance of being clean.

    Null and empty texts get no votes, so they share the corpus's overall chance through the scorer's
    bias; they are never rejected. Repeated rows score alike; an empty table gives no rows. Labels,
    ids and other columns are not looked at. The scorer is fitted on at most ``fit_docs`` distinct
    texts of either kind, whole, the first by a hash of all their words; patterns are counted over all
    documents. For a text with words the scorer alone decides; the votes decide if they name one kind only.
    """
    rows = _rows(docs, text)
    base = 3 ** np.arange(len(LABELLERS))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            pattern, n = np.unique(votes(texts) @ base, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(n)], ["pattern", "n"])

    # at most 3 ** len(LABELLERS) patterns
    counted = rows.select("text").mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    codes = np.array(sorted(r.pattern for r in counted), np.int64)
    held = {r.pattern: r.n for r in counted}
    patterns = codes[:, None] // base % 3
    junk, _ = fit_votes(patterns, np.array([held[c] for c in codes.tolist()], float))
    total = sum(held.values())
    shares = [max(1.0, sum(n for c, n in held.items() if (junk[np.searchsorted(codes, c)] > 0.5) == kind)) for kind in (False, True)] if total else [1.0, 1.0]
    # by hash of the text, some more of either kind than are wanted
    limits = np.array([min(1.0, 2 * fit_docs / s) for s in shares])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            n = len(texts.offsets) - 1
            chance = junk[np.searchsorted(codes, votes(texts) @ base)]
            # by all words of the text, so that texts which begin alike are drawn apart
            draw = range_hash(texts.word_hash, WORD_BASE, texts.first_word[:-1], texts.first_word[1:])
            kind = (chance > 0.5).astype(int)
            taken = np.flatnonzero((draw / 2.0**64 <= limits[kind]) & (np.diff(texts.first_word) > 0))
            taken = taken[np.unique(draw[taken], return_index=True)[1]]
            if not len(taken):
                continue
            at, feature = features(texts)
            cuts = np.searchsorted(texts.doc[at], np.arange(n + 1))
            # at most DIMENSIONS numbers, however long the text
            told = [np.unique(feature[cuts[j] : cuts[j + 1]], return_counts=True) for j in taken]
            lists = [[f.astype(np.int16).tobytes(), c.astype(np.int64).tobytes()] for f, c in told]
            columns = list(zip(*lists))
            yield pa.RecordBatch.from_arrays(
                [pa.array((draw[taken] >> np.uint64(1)).astype(np.int64)), pa.array(chance[taken]), *(pa.array(c, pa.binary()) for c in columns)],
                ["draw", "junk", "features", "counts"],
            )

    # of copies one row travels
    drawn = rows.select("text").mapInArrow(sample, "draw long, junk double, features binary, counts binary").distinct()
    chosen = [r for kind in (F.col("junk") > 0.5, F.col("junk") <= 0.5) for r in drawn.where(kind).orderBy("draw", "features").limit(fit_docs).collect()]
    weights, bias = fit_scorer(
        [(np.frombuffer(r.features, np.int16).astype(np.int64), np.frombuffer(r.counts, np.int64)) for r in chosen], np.array([r.junk for r in chosen])
    )
    one_sided = not any(r.junk > 0.5 for r in chosen) or not any(r.junk <= 0.5 for r in chosen)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            pattern = votes(texts) @ base
            at, feature = features(texts)
            n = np.diff(texts.first_word)
            z = np.bincount(texts.doc[at], weights[feature], batch.num_rows) / np.maximum(1, 4 * n) + bias
            clean = 1 / (1 + np.exp(np.clip(z, -500, 500)))
            if one_sided:
                clean = 1 - junk[np.searchsorted(codes, pattern)]
            clean = np.where(n == 0, np.maximum(clean, 0.5), clean)
            yield pa.RecordBatch.from_arrays([batch.column("rest"), batch.column("text"), pa.array(pattern), pa.array(clean)], ["rest", "text", "pattern", "clean"])

    schema = StructType([rows.schema["rest"], rows.schema["text"], StructField("pattern", LongType()), StructField("clean", DoubleType())])
    return rows.select("rest", "text").mapInArrow(score, schema)


def kept(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents whose chance of being clean is ``least`` or more; a null text comes back as an empty one."""
    found = scored(docs, text).where(F.col("clean") >= least)
    return found.select(*[F.col("text").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
