import numpy as np
import pytest

from corpusops.operators import vectors as V


def frame(spark, ids, matrix, name="id", kind="long"):
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, f"{name} {kind}, embedding array<double>")


def brute(ids, held, asked_ids, asked, k):
    hits = []
    for q, v in zip(asked_ids, asked):
        ranked = sorted((float(np.sqrt(((h - v) ** 2).sum())), i) for i, h in zip(ids, held))
        hits += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(ranked[:k])]
    return sorted((q, rank, i, round(d, 6)) for q, rank, i, d in hits)


def found(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.distance, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def sets():
    rng = np.random.default_rng(5)
    held = rng.normal(size=(600, 12))
    held[100:320] = held[100]  # a third of the index is one vector
    asked = np.vstack([rng.normal(size=(20, 12)), held[100], held[7] + 1e-7])
    return list(range(1000, 1600)), held, list(range(22)), asked


@pytest.mark.parametrize("partitions,slice_bytes", [(1, 1 << 20), (7, 1 << 20), (5, 500)])
def test_search_agrees_with_brute_force(spark, sets, partitions, slice_bytes):
    ids, held, asked_ids, asked = sets
    index = frame(spark, ids, held).repartition(partitions)
    hits = V.search(index, frame(spark, asked_ids, asked, "query_id"), 6, slice_bytes=slice_bytes)
    assert found(hits) == brute(ids, held, asked_ids, asked, 6)


def test_search_in_small_blocks(spark, sets, monkeypatch):
    ids, held, asked_ids, asked = sets
    monkeypatch.setattr(V, "BLOCK_CELLS", 700)
    monkeypatch.setattr(V, "PAIR_BLOCK", 11)
    best = None
    for at in range(0, 600, 130):
        names = __import__("pandas").Series(ids[at : at + 130])
        best = V._merge(best, V._near(asked, held[at : at + 130], names, 6, None, best), 6)
    got = sorted((int(q), int(i), round(d, 6)) for q, d, i in best.itertuples(index=False))
    assert got == sorted((q, i, d) for q, _, i, d in brute(ids, held, asked_ids, asked, 6))


def test_small_distances_rank(spark):
    held = np.arange(10.0, 0, -1)[:, None] * 1e-8
    hits = V.search(frame(spark, range(10), held), frame(spark, [1], np.zeros((1, 1)), "query_id"), 3).collect()
    assert [r.id for r in sorted(hits, key=lambda r: r["rank"])] == [9, 8, 7]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 16])
def test_vectors_that_are_not_finite_come_last(spark, slice_bytes):
    held = [[np.nan, 0], [3, 0], [np.inf, 1], [1, 0]]
    asked = frame(spark, [1, 2], [[0, 0], [np.nan, 0]], "query_id")
    hits = V.search(frame(spark, range(4), held), asked, 3, slice_bytes=slice_bytes)
    got = sorted((r.query_id, r["rank"], r.id, r.distance) for r in hits.collect())
    far = float("inf")
    assert got == [(1, 1, 3, 1.0), (1, 2, 1, 3.0), (1, 3, 0, far), (2, 1, 0, far), (2, 2, 1, far), (2, 3, 2, far)]


def test_large_query_sets_stay_off_the_driver(spark, sets, monkeypatch):
    ids, held, asked_ids, asked = sets
    monkeypatch.setattr(V, "_scan", None)
    hits = V.search(frame(spark, ids, held), frame(spark, asked_ids, asked, "query_id"), 6, slice_bytes=700)
    assert found(hits) == brute(ids, held, asked_ids, asked, 6)


def test_later_batches_without_a_near_row(spark):
    held = np.vstack([np.zeros((5, 3)), np.full((400, 3), 9.0)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        index = frame(spark, range(405), held).coalesce(1).sortWithinPartitions("id")
        hits = V.search(index, frame(spark, [1], np.zeros((1, 3)), "query_id"), 5)
        assert found(hits) == [(1, i + 1, i, 0.0) for i in range(5)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_large_norms_and_text_ids(spark):
    rng = np.random.default_rng(6)
    held, asked = rng.normal(size=(80, 4)) + 5000, rng.normal(size=(4, 4)) + 5000
    ids, names = [f"c{i:02}" for i in range(80)], ["a", "b", "c", "d"]
    hits = V.search(frame(spark, ids, held, kind="string"), frame(spark, names, asked, "query_id", "string"), 3)
    assert found(hits) == brute(ids, held, names, asked, 3)


def test_k_beyond_the_index_and_empty_sides(spark, sets):
    ids, held, asked_ids, asked = sets
    index, queries = frame(spark, ids[:3], held), frame(spark, asked_ids, asked, "query_id")
    assert V.search(index, queries, 10).count() == 3 * len(asked_ids)
    assert V.search(index.where("id < 0"), queries, 10).count() == 0
    assert V.search(index, queries.where("query_id < 0"), 10).count() == 0


def test_vectors_of_another_length_fail(spark):
    index = frame(spark, [1, 2], [[1, 2], [1, 2, 3]])
    with pytest.raises(Exception, match="not 2"):
        V.with_checked_vectors(index, 2).collect()
    with pytest.raises(Exception, match="vector lengths"):
        V.search(index, frame(spark, [1], [[0, 0]], "query_id")).collect()


CHUNKS = [
    ("a.py::f", "a.py", "f", "function", 1, 2, "Adds.", "def f(a, b):\n    return a + b"),
    ("a.py::g", "a.py", "g", "function", 4, 5, None, "def g(a, b):\n    return a - b"),
    ("b.py::h", "b.py", "h", "function", 1, 2, "", "def h(path):\n    return open(path)"),
]
SCHEMA = "id string, file string, name string, type string, start_line int, end_line int, docstring string, code string"


def test_embedded_text(spark):
    texts = [r[0] for r in spark.createDataFrame(CHUNKS, SCHEMA).select(V.embed_text()).collect()]
    assert texts[0] == '# a.py::f (function)\n"""Adds."""\ndef f(a, b):\n    return a + b'
    assert texts[1] == "# a.py::g (function)\ndef g(a, b):\n    return a - b"
    assert '"""' not in texts[2]


def test_index_life_cycle_and_rendering(spark, tmp_path):
    chunks = spark.createDataFrame(CHUNKS, SCHEMA)
    embedder = V.HashedEmbedder(64).fit(chunks.withColumn("text", V.embed_text()))
    path = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        V.load_index(spark, path)
    assert V.build_index(chunks, embedder, path) == 3
    index = V.load_index(spark, path)
    queries = spark.createDataFrame([("q1", "open a path"), ("q2", "zzz")], "query_id string, query string")
    hits = V.search(index, embedder.embed(queries, "query"), 2)
    described = V.describe_hits(hits, index)
    top = described.where("query_id = 'q1' AND rank = 1").select("*", V.hit_id().alias("hit")).first()
    assert (top.hit, top.lines) == ("b.py::h", "1-2")
    texts = {r.query_id: r.output for r in V.rendered_hits(queries, described.where("query_id = 'q1'")).collect()}
    first, second = texts["q1"].split("\n\n")
    assert first == f"--- b.py::h (lines 1-2) ---\n{top.content}" and second.startswith("--- a.py::")
    assert texts["q2"] == "No relevant code found."
    with pytest.raises(ValueError, match="no indexable"):
        V.build_index(chunks.where("file = 'none'"), embedder, path)
    assert V.load_index(spark, path).count() == 3


def test_hashed_vectors_have_unit_length_and_count_rows(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "b c"), (3, ""), (4, None)], "id int, text string")
    embedder = V.HashedEmbedder(32).fit(docs)
    slots = {t: V._slot(t, 32) for t in "abc"}
    assert embedder.weights[slots["b"]] == pytest.approx(np.log(5 / 3))
    assert embedder.weights[slots["a"]] == pytest.approx(np.log(5 / 2))
    vectors = {r.id: np.array(r.embedding) for r in embedder.embed(docs).collect()}
    assert np.linalg.norm(vectors[1]) == pytest.approx(1) and not vectors[3].any() and not vectors[4].any()
    assert vectors[1][slots["b"]] / vectors[1][slots["a"]] == pytest.approx(2 * np.log(5 / 3) / np.log(5 / 2))


def test_model_embedder_loads_per_task(spark):
    def load():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts])

    docs = spark.createDataFrame([("banana",), ("x",)], "text string")
    assert sorted(r.embedding for r in V.ModelEmbedder(load).embed(docs).collect()) == [[1.0, 0.0], [6.0, 3.0]]
