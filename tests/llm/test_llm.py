"""The operators on training data against brute force, on small tables with every awkward row."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusops.llm import best_fit, bit_sliced, byte_conv, hilbert_search, line_dedup, near_copies, piece_scan, prefix_trees, queries, simhash_trie
from corpusops.llm import sparse_suffix, weak_labels
from corpusops.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id string, rest int, marks string"


@pytest.fixture(scope="module")
def rows():
    words = [f"w{i}" for i in range(200)]
    shared = " ".join(words[20:90])
    return [
        (1, "alpha " + shared + " omega", None, 1, "x"),
        (2, "beta\n" + shared + "\tgamma", "a", None, None),
        (2, "beta\n" + shared + "\tgamma", "a", None, None),
        (3, None, None, None, None),
        (4, "", "b", 2, "y"),
        (None, shared, None, 3, None),
        (5, "Ä ß 你好  ▁ <|endoftext|> \x0b end ", "c", 4, "z"),
        (6, " ".join(words * 40), "d", 5, "q"),
        (7, "12 34 ++", None, 6, None),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def removed(rows, size):
    last = 1 << 63
    texts = [((d if d is not None else last), WORD.findall(t or "")) for d, t, *_ in rows]
    least = {}
    for d, w in texts:
        for a in range(len(w) - size + 1):
            key = tuple(w[a : a + size])
            least[key] = min(least.get(key, d), d)
    out = []
    for (d, w), row in zip(texts, rows):
        gone = [False] * len(w)
        for a in range(len(w) - size + 1):
            if least[tuple(w[a : a + size])] < d:
                gone[a : a + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(row[0]), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("drop, size", [(prefix_trees.drop_repeats, 13), (sparse_suffix.drop_passages, 50)])
def test_repeats_equal_brute_force(spark, docs, rows, drop, size):
    got = drop(docs).select(F.col("rest.doc_id").cast("string"), "out.n_words", "out.n_removed", "out.kept_sha256").collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == removed(rows, size)
    assert drop(docs.limit(0)).count() == 0


def test_heavy_groups_give_the_same_result(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(sparse_suffix, "HEAVY_SHARE", 1 << 40)
    monkeypatch.setattr(prefix_trees, "HEAVY_SHARE", 1 << 40)
    for drop, size in ((prefix_trees.drop_repeats, 13), (sparse_suffix.drop_passages, 50)):
        got = drop(docs).select(F.col("rest.doc_id"), "out.n_words", "out.n_removed", "out.kept_sha256").collect()
        assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == removed(rows, size)


def test_passages_leave_other_white_space(spark, docs):
    left = {r.doc_id: r.text for r in sparse_suffix.deduplicated(docs).collect()}
    assert left[2] == "beta\ngamma" and left[None] == "" and left[3] == ""
    assert sparse_suffix.deduplicated(docs).columns == docs.columns


def test_lines(spark):
    rows = [(i % 12, f"Head {i % 12}\n SAME line\n\nb") for i in range(14)] + [(None, None), (20, ""), (21, "same LINE \x0b")]
    got = line_dedup.drop_frequent_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.row.text or ""
        kept = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r").lower() not in ("same line", "b")]
        assert r.kept == "\n".join(kept) and r.n_lines == text.count("\n") + 1 and r.n_dropped == r.n_lines - len(kept)


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints(spark, docs, rows):
    got = simhash_trie.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64)) for r in got) == sorted((str(d), fingerprint(t)) for d, t, *_ in rows)
    kept = simhash_trie.deduplicated(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 2").count() <= 1
    assert simhash_trie.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("subtree", [1 << 17, 0])
def test_trie_join_finds_every_link(spark, monkeypatch, subtree):
    monkeypatch.setattr(simhash_trie, "SUBTREE", subtree)
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2)
    flips = [b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in draw.integers(0, 64, (5, 2))]
    values = np.unique(np.concatenate([base, np.array(flips, np.uint64)]))
    frame = spark.createDataFrame([(i, int(v)) for i, v in enumerate(values.view(np.int64))], "node long, fp long")
    found = {r.u: r.v for r in components(simhash_trie.links(frame)).collect()}
    root = list(range(len(values)))
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
    while True:
        before = list(root)
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert found == {i: r for i, r in enumerate(root) if r != i}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    assert {r.u: r.v for r in components(edges).collect()} == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_packing(spark, docs, rows):
    got = queries.packed(docs).collect()
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = defaultdict(list)
    for d, t, *_ in rows:
        texts[d].append(known.encode(t or "", add_special_tokens=False).ids + [2])
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for d, own in texts.items():
        want = []
        for ids in own:
            first = len(ids) % 1024 or 1024
            cuts = [0, *range(first, len(ids) + 1, 1024)]
            want += [(n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(pieces[d]) == sorted(want)
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert queries.packed(docs.limit(0)).count() == 0


def test_every_capacity_holds():
    draw = np.random.default_rng(1)
    counts = {int(n): int(c) for n, c in zip(range(1, 101), draw.integers(0, 50, 100)) if c}
    plan = best_fit.pack_lengths(counts, 100, 4, 6000 + 100 * 100)
    loads = defaultdict(list)
    for n, c in counts.items():
        at, offset = plan.places(np.full(c, n), np.arange(c))
        for b, o in zip(at.tolist(), offset.tolist()):
            loads[b].append((o, n))
    assert len(loads) == plan.bins and all(len(v) <= 4 for v in loads.values())
    for held in loads.values():
        ends = list(itertools.accumulate(n for _, n in sorted(held)))
        assert [o for o, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 100


VECTORS = [(1, [0.5, -0.25]), (50, [1.0, 1.0]), (100, None), (150, [float("nan"), 1.0]), (200, [None, 1.0]), (250, [0.0, 0.0]), (None, [1.0, 2.0])]


def test_top_k_equals_brute_force(spark):
    rows = [*VECTORS, (3, [0.5, -0.25]), (3, [0.9, 0.1]), *[(60 + i, [0.1 * i, -0.3]) for i in range(20)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = bit_sliced.top_k(frame, F.col("vec_id") % 50 == 0)
    fit = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if i and v and None not in v and np.isfinite(v).all()]
    want = []
    for q, v in fit:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in fit if i != q)[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert bit_sliced.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    held = sorted(table.collect(), key=lambda r: r.vec_id)
    unit = np.array([r.embedding for r in held])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    ids = np.array([r.vec_id for r in held])
    found = defaultdict(set)
    for r in hilbert_search.nearest(table, F.col("vec_id") % 50 == 0).collect():
        found[r.query_id].add(r.vec_id)
    hits = [len(found[ids[j]] & set(ids[np.argsort(-np.where(ids == ids[j], -9, unit @ unit[j]))[:5]].tolist())) / 5 for j in np.flatnonzero(ids % 50 == 0)]
    assert np.mean(hits) >= 0.9
    odd = spark.createDataFrame([*VECTORS, *[(60 + i, [1.0, 1.0]) for i in range(20)]], "vec_id long, embedding array<float>")
    got = [r.vec_id for r in hilbert_search.nearest(odd, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [60, 61, 62, 63, 64]


def test_languages(spark):
    got = queries.op2_byte_conv_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.9 and all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 ++", "en"), (3, "word", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in byte_conv.predict(odd, F.lit(True)).collect()} == {"und"}


def test_every_language_is_learned(spark):
    names = [f"l{i:03}" for i in range(100)]
    table = spark.createDataFrame([(i, f"{x} {x}", x) for i, x in enumerate(names)], "doc_id long, text string, lang string")
    assert byte_conv.fitted(table, F.lit(True), "text", "lang").languages == names


def test_quality(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op6_weak_label_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    assert np.mean([r.keep == bool(r.quality) for r in got]) > 0.98
    assert weak_labels.kept(docs).columns == docs.columns and weak_labels.kept(docs.limit(0)).count() == 0
    assert weak_labels.kept(docs.where("doc_id in (3, 4)")).count() == 2


def test_pieces(spark, docs, rows):
    model = public_tokenizers.path("piece_bpe_32k.model")
    made = piece_scan.Pieces(model)

    def score(ids):
        return sum(made.scores.get(made_piece.get(i), made.fallback) for i in np.frombuffer(ids, "<u4").tolist())

    made_piece = {i: p for p, i in made.ids.items()}
    for chunk in (piece_scan.CHUNK, 50):
        got = piece_scan.encoded(docs, model, chunk=chunk).collect()
        assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(d), t or "") for d, t, *_ in rows)
        for r in got:
            text = piece_scan.marked(r.decoded)
            if text:
                assert abs(score(bytes(r.ids)) - made.reach(text, 0, len(text))[0][-1]) < 1e-3 * max(1, len(text))


def jaccard_roots(texts, words=5):
    sets = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))})
    root = list(range(len(sets)))
    near = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    before = None
    while root != before:
        before = list(root)
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    return root, near


@pytest.mark.parametrize("sample, common", [(16, 4), (1, 2)])
def test_near_copies_equal_brute_force(spark, monkeypatch, sample, common):
    import corpus_pipeline

    monkeypatch.setattr(near_copies, "SAMPLE", sample)
    monkeypatch.setattr(near_copies, "COMMON", common)
    draw = np.random.default_rng(11)
    texts = []
    for n in (4, 5, 9, 30, 60, 200, 200, 400):
        base = [f"w{i}" for i in draw.integers(0, 10**6, n)]
        for edits in (0, 0, 1, 1, 2, 3, 4, 6, 9, 12):
            copy = list(base)
            for at in draw.integers(0, n, edits):
                copy[at] = f"X{draw.integers(0, 10**6)}"
            texts.append(" ".join(copy))
    root, near = jaccard_roots(texts)
    close = [a for a, b in near if texts[a] != texts[b]]
    assert len(close) > 30
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, table, SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))
    found = {(r.v, r.u) for r in near_copies.links(table.select(F.col("doc_id").alias("node"), "text")).collect()}
    assert found == set(near)


def test_unlike_documents_without_or_with_one_id_stay(spark):
    import corpus_pipeline

    unlike = [" ".join(f"{name}{i}" for i in range(20)) for name in "abcdefg"]
    rows = [(None, unlike[0]), (None, unlike[1]), (5, unlike[1] + " end"), (None, unlike[2]), (7, unlike[3]), (7, unlike[4]), (7, unlike[4]), (8, unlike[4]), (None, None), (9, " \n")]
    for some in (rows, [r for r in rows if r[0] is None], rows[4:8]):
        table = spark.createDataFrame(some, "doc_id long, text string")
        kept = {(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, table, SF).collect()}
        wanted = {(None, unlike[0]), (5, unlike[1] + " end"), (None, unlike[2]), (7, unlike[3]), (7, unlike[4]), (9, " \n")}
        if some is not rows:
            wanted = {r for r in some if r[0] != 8}
        assert kept == wanted
        assert corpus_pipeline.near_duplicates(spark, table, SF).count() == len(wanted)


def test_pieces_of_long_texts_with_word_marks(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    made = piece_scan.Pieces(model)
    mark = piece_scan.MARK
    texts = [f"a {mark} b{mark}c " * 30, mark * 120, mark + "word " * 40 + mark, " " * 60 + mark * 60, "x" * 49, "x" * 50 + mark, mark * 49, mark * 50]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in piece_scan.encoded(table, model, chunk=50).collect()}
    assert [got[i].decoded for i in range(len(texts))] == texts
    piece = {i: p for p, i in made.ids.items()}
    for i, text in enumerate(texts):
        total = sum(made.scores[piece[x]] if x in piece else made.fallback for x in np.frombuffer(bytes(got[i].ids), "<u4").tolist())
        seen = piece_scan.marked(text)
        assert abs(total - made.reach(seen, 0, len(seen))[0][-1]) < 1e-3 * len(seen)


def test_pipeline_runs(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).count() > 0
