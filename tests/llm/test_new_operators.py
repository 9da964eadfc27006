"""Toxicity, vector codes and spelling variants against brute force, on small tables with every awkward row."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from parity import compare
from pyspark.sql import functions as F

from corpusops.llm import anchor_codes, clause_grammar, queries, word_variants
from corpusops.llm.words import texts_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_anchor_codes", "op13_dense_affix_variants"])
def test_queries_agree_with_their_sql(spark, name):
    query, sql = queries.QUERIES[name]
    count, difference = compare(spark, name, query, sql, SF)
    assert count > 0 and not difference


# ---------------------------------------------------------------- spelling variants


def edits_apart(a, b):
    """One insertion, deletion or replacement, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if edits_apart(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out)


@pytest.fixture(scope="module")
def spelled():
    draw = random.Random(3)
    stems = ["Straßenbahn", "économie", "niñosñÿ", "aaaaaaa", "aaaaaaaa", "Xylophone", "internationalisation", "ÀÉÎÕÜÝÞ"]
    words = []
    for stem in stems:
        for _ in range(60):
            at = draw.randrange(len(stem))
            kind = draw.randrange(4)
            words.append({0: stem, 1: stem[:at] + stem[at + 1 :], 2: stem[:at] + draw.choice("abxñÿ") + stem[at:], 3: stem[:at] + draw.choice("abxñÿ") + stem[at + 1 :]}[kind])
    rows = [(i, " ".join(draw.choices(words, k=40)) + ("×÷ " + "z" * 20) * (i % 3)) for i in range(60)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, "Xylophone xylophone XYLOPHONE"), (None, None), (70, ""), (71, "w" * 5000 + " " + "w" * 5001), (72, "w" * 5000 + " " + "w" * 5001)]
    return rows


def test_variants_equal_brute_force(spark, spelled, monkeypatch):
    table = spark.createDataFrame([(d, t, "x", 1, None) for d, t in spelled], "doc_id long, text string, word string, n int, `a.form` string")
    wanted = brute_variants(spelled)
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    assert any(f for _, _, _, f, _, _ in wanted) and any(k > 1 for _, _, k, *_ in wanted)
    assert sorted(tuple(r) for r in word_variants.variants(table).select(*columns).collect()) == wanted
    # groups cut into many tiles
    monkeypatch.setattr(word_variants, "BLOCK_WORDS", 3)
    assert sorted(tuple(r) for r in word_variants.variants(table).select(*columns).collect()) == wanted
    assert word_variants.variants(table.limit(0)).count() == 0


def test_chains_of_forms_end_at_their_root(spark):
    rows = [(1, " ".join(["abcdefgh"] * 2 + ["abcdefgx"] * 30 + ["abcdefyx"] * 400))]
    got = {r.word: r.root for r in word_variants.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {r[0]: r[5] for r in brute_variants(rows)} and len(set(got.values())) == 1


def test_pairs_in_small_tiles():
    draw = random.Random(5)
    words = sorted({"".join(draw.choices("ab", k=n)) for n in (7, 8) for _ in range(60)})
    m, names = np.full(len(words), 8), [w.encode("latin-1") for w in words]
    wanted = {(a, b) for a, b in itertools.combinations(words, 2) if edits_apart(a, b) and max(len(a), len(b)) == 8}
    for cells in (1 << 22, 600, 3):
        a, b = word_variants.near_pairs(names, np.zeros(len(words), int), m, np.zeros(len(words), bool), np.full(len(words), -1), cells)
        assert sorted((words[i], words[j]) for i, j in zip(a, b)) == sorted(wanted)


# ---------------------------------------------------------------- vector codes


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v], label) for i, v, label in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    order = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in order] for p in range(parts)]

    def nearest(v, p):
        piece = v[p * width : (p + 1) * width]
        return min((sum((x - y) ** 2 for x, y in zip(piece, e)), at) for at, e in enumerate(books[p]))

    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(v, p)[1], []).append(v[p * width : (p + 1) * width])
            fresh.append([[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[p])])
        books = fresh
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], Counter()
    for i, v, label in kept:
        best = [nearest(v, p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
        sums[label] += out[-1][2]
    return sorted((str(i), code, error, sums[label], digest) for i, code, error, label in out)


def vectors(n=300, dims=32, seed=1):
    draw = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in draw.normal(size=dims).round(1)], int(i % 5) if i % 7 else None) for i in range(n)]
    hot = rows[3][1]
    rows += [(n + i, hot, 2) for i in range(100)]
    rows += [(5, rows[5][1], None), (None, rows[9][1], 1), (900, None, 1), (901, [None] * dims, 1), (902, [float("nan")] * dims, 1), (903, [float("inf")] * dims, 1), (904, [], 1)]
    return rows


@pytest.mark.parametrize("n", [300, 20])
def test_codes_equal_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(anchor_codes, "BLOCK_ROWS", 150)
    rows = vectors(n)
    table = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    columns = [F.col("vec_id").cast("string"), "code", "error", "label_error", "codebooks_sha256"]
    got = sorted((str(r[0]), *r[1:]) for r in anchor_codes.encoded(table).select(*columns).collect())
    assert got == brute_codes(rows)
    assert anchor_codes.encoded(table.limit(0)).count() == 0
    assert anchor_codes.encoded(table.where("vec_id > 899 and vec_id < 905")).count() == 0


def test_vectors_that_cannot_be_coded_end_the_job(spark):
    for bad in ([1e200] * 16, [0.5] * 15):
        with pytest.raises(Exception, match="too large|one length"):
            anchor_codes.encoded(spark.createDataFrame([(1, bad, 1)], "vec_id long, embedding array<double>, label int")).collect()
    with pytest.raises(Exception, match="vector lengths"):
        rows = [(i, [0.5] * 16, 1) for i in range(80)] + [(99, [0.5] * 32, 1)]
        anchor_codes.encoded(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()


def test_a_tree_owns_whole_balls():
    draw = np.random.default_rng(2)
    points = np.concatenate([draw.integers(-5, 5, (400, 4)) + far for far in (0, 1000, -3000)])
    tree = anchor_codes.build_tree(points)
    assert sorted(tree.perm) == list(range(len(points)))
    for (start, end, left, right), total, ball in zip(tree.spans, tree.sums, tree.balls):
        inside = points[tree.perm[start:end]]
        assert (inside.sum(0) == total).all() and (((inside - ball[:-1]) ** 2).sum(1) <= ball[-1] ** 2 + 1e-6).all()
        assert left < 0 or (tree.spans[left][0] == start and tree.spans[left][1] == tree.spans[right][0] and tree.spans[right][1] == end)
    for book in (points[:7], np.repeat(points[:1], 3, 0), np.array([[0, 0, 0, 0], [1000] * 4, [-3000] * 4])):
        codes, totals, counts = anchor_codes.assign(tree, points, book)
        away = ((points[:, None] - book[None]) ** 2).sum(-1)
        assert (codes == away.argmin(1)).all() and (counts == np.bincount(codes, minlength=len(book))).all()
        assert all((points[codes == e].sum(0) == totals[e]).all() for e in range(len(book)))
    # three far clusters need no look at their points
    assert len(tree.spans) > 50


# ---------------------------------------------------------------- toxicity


def patterns(text, *insults):
    lexicon = np.sort(np.array([clause_grammar.term_hash(w) for w in insults], np.uint64))
    import pyarrow as pa

    counts = clause_grammar.pattern_counts(texts_of(pa.array([text])), lexicon)[0]
    return {int(p): int(counts[p]) for p in np.flatnonzero(counts)}


def test_clauses_tell_their_patterns():
    insult, threat, target, denied, quoted = 1, 2, 4, 8, 16
    assert patterns("You are an IDIOT.", "idiot") == {insult + target: 1}
    assert patterns("You are not an idiot. idiots!", "idiot") == {insult + target + denied: 1}
    assert patterns("Not so, you idiot", "idiot") == {insult + target: 1}
    assert patterns("An idiot, not he", "idiot") == {insult + target: 1}
    assert patterns("He said: you idiot. She said you idiot", "idiot") == {insult + target: 1, insult + target + quoted: 1}
    assert patterns("I kill you\nidiot;scum", "idiot", "scum") == {threat + target: 1, insult: 2}
    assert patterns("", "idiot") == patterns("fine words only, you", "idiot") == {}


def test_the_composition_reaches_only_states_of_its_parts():
    moves, tells = clause_grammar.composed(clause_grammar.GRAMMAR)
    assert len(moves) == len(tells) <= 2 * 2 * 2 * 3 * 3 and moves.max() < len(moves) and moves.shape[1] == 6
    # a lone transducer composed with none other is itself
    moves, tells = clause_grammar.composed((clause_grammar.DENIED,))
    assert tells.tolist() == [0, 0, 1] and moves[0][clause_grammar.NEGATION] == 1


def test_accented_capitals_and_stems():
    import pyarrow as pa

    words = clause_grammar.lettered(texts_of(pa.array(["ÉCOLE × École", "zażółć"])))
    h = clause_grammar.terms(words)
    assert words.data.tobytes().decode()[:5] == "école" and h[0, 0] == h[2, 0] == clause_grammar.term_hash("école")
    assert h[0, 1] == clause_grammar.term_hash("écol", True) and h[0, 2] == 0


@pytest.fixture(scope="module")
def spoken():
    draw = random.Random(4)
    plain = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(400):
        text = draw.choices(plain, k=30)
        if i % 4 == 0:
            text[draw.randrange(30)] = "you " + draw.choice(["gnarf", "blorkish", "blorkest", "Zwump"])
        docs.append((i, " ".join(text) + "."))
        labels.append((i, int(i % 4 == 0)))
    return docs, labels


def test_held_out_texts_are_told_and_clean_ones_left_alone(spark, spoken):
    docs, labels = spoken
    docs = docs + [(None, "you gnarf"), (1000, None), (1001, ""), (1002, "word1 " * 40000 + "you gnarf"), (0, docs[0][1])]
    table = spark.createDataFrame([(d, t, 1, "x", 2.0) for d, t in docs], "doc_id long, text string, toxic int, held_out string, score double")
    known = spark.createDataFrame([(d, x, None) for d, x in labels] + [(None, 1, None), (3, None, None)], "doc_id long, toxic int, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = clause_grammar.scored(table, known, held).collect()
    assert len(got) == len(docs)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id], r
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].predicted == 1 and by_id[1000].predicted == by_id[1001].predicted == 0 and by_id[1002].predicted == 1
    # held-out labels change nothing
    turned = known.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {(r.doc_id, r.score) for r in clause_grammar.scored(table, turned, held).collect()}
    assert again == {(r.doc_id, r.score) for r in got}
    assert clause_grammar.scored(table.limit(0), known, held).count() == 0
    assert {r.score for r in clause_grammar.scored(table, known.limit(0), held).collect()} == {0.0}


def test_toxicity_of_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op11_clause_grammar(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels if got[r.doc_id].held_out]
    caught = sum(p for p, t in held if t == 1) / max(1, sum(t == 1 for _, t in held))
    spared = sum(1 - p for p, t in held if t == 0) / sum(t == 0 for _, t in held)
    # of six held-out toxic texts two are in languages with four and three examples, which no lexicon comes from
    assert caught >= 0.6 and spared >= 0.99, (caught, spared, len(held))
