"""A toxicity score by a weighted grammar over clauses.

Labelled texts give a lexicon of insults. Five small transducers read the symbols of a clause: insult,
threat, target, negation and reported speech. Their composition is one automaton, and the state it
ends a clause in names the pattern that the clause matches: say, an insult at a target, negated, in
reported speech. Weights of patterns are fitted on labelled texts; a text's score comes from the
clauses that match, so a word counts by what its clause does with it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.llm.words import BYTE_BASE, BYTE_VALUES, Texts, mix, range_hash, slices
from corpusops.session import durable

# labelled documents of either class that the fit takes at most, drawn by a hash of the id
FIT_DOCS = 2048
# terms that may enter the lexicon at most, and how often each document asks to be covered by it
CANDIDATES = 1 << 14
COVERS = 4
# a term needs so many toxic documents, as a share of them and at least; a clean one outweighs so many
MIN_SHARE, MIN_DOCS, CLEAN_WEIGHT = 0.002, 3, 20
# besides whole words, the first so many letters of a word are terms: inflected forms share them
STEMS = (4, 5, 6)

# symbols of a clause: other words are not read, so that clauses stay short
COMMA, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Closed word classes of English, German, French and Spanish.
TARGETS = "you your he him his she her they them their this that these those du dich dir dein ihr euch er sie dieser diese tu toi te vous votre il elle ils ce cette tú ti tu usted él ella ellos este esta"
NEGATIONS = "not no never neither nor none cannot nicht kein keine nie niemals ne pas jamais aucun ni nunca jamás ningún"
REPORTS = "said says say told wrote called claims claimed asked quoted sagte sagt schrieb nannte behauptet dit disait écrit appelé prétend dijo dice escribió llamó afirma"
THREATS = "kill hurt destroy burn beat shoot stab töten umbringen schlagen verbrennen tuer frapper détruire brûler matar golpear destruir quemar"


@dataclass(frozen=True)
class Transducer:
    """Reads symbols from state 0 on; a symbol without an entry leaves the state as it is. ``tells`` is the output of a state at the end of a clause."""

    moves: dict[tuple[int, int], int]
    tells: tuple[int, ...]


def noted(symbol: int, forgets: tuple[int, ...] = ()) -> Transducer:
    """Tells whether ``symbol`` was read since the last of ``forgets``."""
    return Transducer({(0, symbol): 1, **{(1, s): 0 for s in forgets}}, (0, 1))


# an insult or a threat counts wherever it stands; a target must be in its phrase
INSULTS, THREATENED, AIMED = noted(INSULT), noted(THREAT), noted(TARGET)
# a negation reaches to the next comma; one behind the insult does not undo it
DENIED = Transducer({(0, NEGATION): 1, (1, COMMA): 0, (1, INSULT): 2, (1, THREAT): 2}, (0, 0, 1))
# reported speech starts with its verb, which stands before what is reported
QUOTED = Transducer({(0, REPORT): 1, (1, INSULT): 2, (1, THREAT): 2}, (0, 0, 1))
GRAMMAR = (INSULTS, THREATENED, AIMED, DENIED, QUOTED)


def composed(parts: tuple[Transducer, ...]) -> tuple[np.ndarray, np.ndarray]:
    """One automaton for all: (state, symbol) moves over the states that can be reached, and the pattern each state tells."""
    states, todo, moves = {(0,) * len(parts): 0}, [(0,) * len(parts)], []
    while todo:
        at = todo.pop(0)
        row = []
        for symbol in range(6):
            to = tuple(t.moves.get((s, symbol), s) for t, s in zip(parts, at))
            if to not in states:
                states[to] = len(states)
                todo.append(to)
            row.append(states[to])
        moves.append(row)
    tells = [sum(t.tells[s] << i for i, (t, s) in enumerate(zip(parts, state))) for state in states]
    return np.array(moves), np.array(tells)


PATTERNS = 1 << len(GRAMMAR)
# patterns with an insult or a threat score; the others are no more than words
SCORING = np.array([p for p in range(PATTERNS) if p & 3])


def lettered(texts: Texts) -> Texts:
    """Lower-case letters with everything else as spaces: its words are the runs of letters."""
    data = texts.data
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    out = np.where(letter, data | (upper.astype(np.uint8) << 5), 32).astype(np.uint8)
    # Latin capitals with accents lie in one row of two-byte sequences
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[second] += 0x20
    return Texts(out, texts.offsets)


def ranked(hashes: np.ndarray, rank: int) -> np.ndarray:
    return (hashes & ~np.uint64(3)) | np.uint64(rank)


def terms(words: Texts) -> np.ndarray:
    """(word, term) hashes: the whole word, then its first letters for each size in ``STEMS`` (0: the word is no longer).

    The two lowest bits rank terms: whole words before stems, long stems before short ones.
    """
    starts, ends = words.starts, words.ends
    out = np.zeros((len(starts), 1 + len(STEMS)), np.uint64)
    if not len(starts):
        return out
    out[:, 0] = ranked(words.word_hash, 0)
    letters = np.flatnonzero((words.data & 0xC0) != 0x80)
    first = np.searchsorted(letters, starts)
    padded = np.append(letters, np.full(max(STEMS) + 1, len(words.data)))
    values = BYTE_VALUES[words.data]
    for j, size in enumerate(STEMS, 1):
        until = padded[first + size]
        longer = until < ends
        stem = range_hash(values, BYTE_BASE, starts[longer], until[longer])
        out[longer, j] = ranked(mix(stem + np.uint64(size)), 1 + len(STEMS) - j)
    return out


def term_hash(word: str, stem: bool = False) -> int:
    """The hash of one term, as ``terms`` gives it."""
    data = np.frombuffer(word.encode(), np.uint8)
    value = range_hash(BYTE_VALUES[data], BYTE_BASE, np.array([0]), np.array([len(data)]))
    return int((ranked(mix(value + np.uint64(len(word))), len(STEMS) - STEMS.index(len(word))) if stem else ranked(value, 0))[0])


def word_class(words: str) -> np.ndarray:
    return np.sort(np.array([term_hash(w) for w in words.split()], np.uint64))


CLASSES = ((REPORT, word_class(REPORTS)), (NEGATION, word_class(NEGATIONS)), (TARGET, word_class(TARGETS)), (THREAT, word_class(THREATS)))
MOVES, TELLS = composed(GRAMMAR)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``known``."""
    if not len(known):
        return np.zeros(values.shape, bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def pattern_counts(texts: Texts, lexicon: np.ndarray) -> np.ndarray:
    """(document, pattern) number of clauses that end in each pattern; only clauses with an insult or a threat are read."""
    n = len(texts.offsets) - 1
    out = np.zeros((n, PATTERNS), np.int64)
    words = lettered(texts)
    h = terms(words)
    if not len(h):
        return out
    symbol = np.full(len(h), -1)
    for kind, members in CLASSES:
        symbol[among(h[:, 0], members)] = kind
    symbol[among(h, lexicon).any(1)] = INSULT
    # a clause ends with a sentence or line; commas stay inside
    stop = np.isin(texts.data, np.frombuffer(b".!?;:\n|", np.uint8))
    clause_of_byte = np.cumsum(stop)
    commas = np.flatnonzero(texts.data == 44)
    at = np.concatenate([words.starts, commas])
    read = np.concatenate([symbol, np.full(len(commas), COMMA)])
    # documents never share a clause
    doc = np.concatenate([words.doc, np.searchsorted(texts.offsets, commas, "right") - 1])
    clause = clause_of_byte[at] * (n + 1) + doc
    told = np.unique(clause[(read == INSULT) | (read == THREAT)])
    keep = (read >= 0) & np.isin(clause, told)
    at, read, doc, clause = at[keep], read[keep], doc[keep], clause[keep]
    order = np.lexsort((at, clause))
    read, doc, clause = read[order], doc[order], clause[order]
    starts = np.flatnonzero(np.append(True, clause[1:] != clause[:-1])) if len(clause) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(clause)))
    state = np.zeros(len(starts), np.int64)
    # all clauses step together, the longest first, so that each step is a head of the list
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    for step in range(int(sizes.max(initial=0))):
        live = int(np.searchsorted(-sizes, -step, "left"))
        state[:live] = MOVES[state[:live], read[starts[:live] + step]]
    np.add.at(out, (doc[starts], TELLS[state]), 1)
    return out


def features(counts: np.ndarray) -> np.ndarray:
    """Matched clauses by pattern, on a log scale, and whether there are any."""
    scoring = counts[:, SCORING]
    return np.concatenate([np.log1p(scoring), (scoring.sum(1, keepdims=True) > 0)], 1)


def fit_weights(x: np.ndarray, y: np.ndarray, rounds: int = 400, decay: float = 0.01) -> np.ndarray:
    """Logistic weights and, last, a bias: Newton steps on the ridge loss. Classes weigh alike."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    ridge = np.append(np.full(x.shape[1] - 1, decay), 1e-6)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (share * (p - y)) + ridge * w
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        # short steps keep the loss falling where the fit is nearly perfect
        w -= step * min(1.0, 2 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def chosen_terms(members: list[np.ndarray], loss: list[float], rank: list[int], least: int, covers: int = COVERS) -> list[int]:
    """Greedy cover: the term that covers most documents not yet covered ``covers`` times, less its ``loss``, while that leaves ``least``.

    Of copies of one text one is given here, so that what only one text says is no term. Ties go to the lower rank, then number.
    """
    holders: dict[int, list[int]] = {}
    for doc, some in enumerate(members):
        for term in some.tolist():
            holders.setdefault(term, []).append(doc)
    open_ = [covers] * len(members)
    heap = [(loss[term] - len(docs), rank[term], term) for term, docs in holders.items()]
    heapq.heapify(heap)
    out = []
    while heap:
        gain, place, term = heapq.heappop(heap)
        now = sum(open_[d] > 0 for d in holders[term]) - loss[term]
        if now < least:
            continue
        if now < -gain:
            heapq.heappush(heap, (-now, place, term))
            continue
        out.append(term)
        for d in holders[term]:
            open_[d] -= 1
    return out


def _training(docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str, text: str, label: str, fit_docs: int) -> DataFrame:
    """(draw, text, toxic): at most ``fit_docs`` labelled documents of either class, written once.

    Of documents with one least hash of three words, as most near copies have it, one is an example:
    what is said in one text only, however often copied, is no evidence.
    """
    own = F.col(f"`{doc_id}`")
    known = labels.where(~F.coalesce(held_out, F.lit(True))).groupBy(own.alias("id")).agg(F.max(f"`{label}`").alias("toxic")).where(F.col("toxic").isin(0, 1))
    draw = F.xxhash64(F.col("id"), F.lit(11))
    # 2 * fit_docs ids at most: the texts stay where they are
    some = [known.where(F.col("toxic") == kind).orderBy(draw, "id").limit(fit_docs) for kind in (0, 1)]
    ids = F.broadcast(some[0].union(some[1]))
    rows = docs.select(own.alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            least = np.full(batch.num_rows, np.iinfo(np.uint64).max)
            for size in (1, 3):
                at = texts.windows(size)
                # the longer runs' hash counts where there are any
                least[np.unique(texts.doc[at])] = np.iinfo(np.uint64).max
                np.minimum.at(least, texts.doc[at], texts.window_hash(size, at) if len(at) else np.zeros(0, np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), batch.column("toxic").cast(pa.int32()), batch.column("text")], ["draw", "toxic", "text"])

    signed = rows.join(ids, "id").select("text", "toxic").mapInArrow(sign, "draw long, toxic int, text string")
    return durable(signed.groupBy("draw", "toxic").agg(F.min("text").alias("text")))


def lexicon_of(train: DataFrame) -> np.ndarray:
    """Hashes of the terms that mark toxic texts of (draw, text, toxic)."""
    sizes = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * sizes.get(1, 0)))

    def distinct(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        words = lettered(texts)
        h = terms(words)
        doc = np.repeat(words.doc, h.shape[1])
        h = h.ravel()
        doc, h = doc[h != 0], h[h != 0]
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        fresh = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
        return doc[fresh], h[fresh]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            doc, h = distinct(texts)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[doc] == 1
            term, back = np.unique(h, return_inverse=True)
            n = [np.bincount(back[side], minlength=len(term)) for side in (toxic, ~toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), *(pa.array(x.astype(np.int64)) for x in n)], ["term", "toxic", "clean"])

    counted = train.select("text", "toxic").mapInArrow(count, "term long, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # of as many clean documents as toxic ones
    weight = CLEAN_WEIGHT * sizes.get(1, 0) / max(1, sizes.get(0, 0))
    gain = F.col("toxic") - F.lit(weight) * F.col("clean")
    marking = counted.where(gain >= least).orderBy(gain.desc(), "term").limit(CANDIDATES).collect()
    candidates = np.array([r.term for r in marking], np.int64).view(np.uint64)
    order = np.argsort(candidates)
    candidates, loss = candidates[order], [weight * marking[i].clean for i in order]
    if not len(candidates):
        return candidates

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            doc, h = distinct(texts)
            place = np.minimum(np.searchsorted(candidates, h), len(candidates) - 1)
            hit = candidates[place] == h
            doc, place = doc[hit], place[hit].astype(np.int16)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            lists = [place[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("draw"), pa.array(lists, pa.binary())], ["draw", "terms"])

    # FIT_DOCS rows of at most CANDIDATES short numbers
    held = train.where(F.col("toxic") == 1).select("text", "draw").mapInArrow(hold, "draw long, terms binary").collect()
    members = [np.frombuffer(r.terms, np.int16).astype(np.int64) for r in sorted(held, key=lambda r: (r.draw, r.terms))]
    return np.sort(candidates[chosen_terms(members, loss, (candidates & np.uint64(3)).tolist(), least)])


def weights_of(train: DataFrame, lexicon: np.ndarray) -> np.ndarray | None:
    """Fitted weights of the patterns; None without examples of both classes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            counts = pattern_counts(texts, lexicon)
            yield pa.RecordBatch.from_arrays([batch.column("draw"), batch.column("toxic").cast(pa.int32()), pa.array(counts.tolist(), pa.list_(pa.int64()))], ["draw", "toxic", "counts"])

    rows = sorted(train.mapInArrow(read, "draw long, toxic int, counts array<long>").collect(), key=lambda r: (r.draw, r.toxic))
    y = np.array([r.toxic for r in rows], float)
    if len(set(y)) < 2:
        return None
    return fit_weights(features(np.array([r.counts for r in rows])), y)


def scored(
    docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fit_docs: int = FIT_DOCS
) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_matched) per row of ``docs``: the chance of label 1 and the number of matched clauses.

    ``held_out`` is a condition on the id; where it holds or is null, labels are not looked at. An id
    with several labels counts as 1 if one of them is. The fit takes at most ``fit_docs`` labelled
    documents of either class, whole, of near copies one; every text is scored whole. Null and empty
    texts match nothing and get the score of a text without matches; without labels of both classes
    that is 0 for all. Repeated rows score alike; rows without an id are kept; an empty table gives no
    rows. Other columns are not read.
    """
    train = _training(docs, labels, held_out, doc_id, text, label, fit_docs)
    lexicon = lexicon_of(train)
    weights = weights_of(train, lexicon)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            counts = pattern_counts(texts, lexicon)
            x = features(counts)
            z = np.full(len(x), -np.inf) if weights is None else x @ weights[:-1] + weights[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700))) if weights is not None else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(counts[:, SCORING].sum(1))],
                ["doc_id", "held_out", "score", "predicted", "n_matched"],
            )

    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, n_matched long")
