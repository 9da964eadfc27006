"""Memory of search and embedding over batches larger than a run, and equal results however they are cut."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from corpusops.operators import vectors as V
from corpusops.plans.inputs import passages_in_documents

DIMS = 512


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("rows", [2_000, 10_000])
def test_search_memory_does_not_follow_the_batch_or_its_ties(rows):
    held = pa.FixedSizeListArray.from_arrays(pa.array(np.zeros(rows * DIMS)), DIMS).cast(pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), held], ["id", "vector"])
    names, asked = pd.Series(range(10)), np.ones((10, DIMS))
    found = []
    assert peak_mb(lambda: found.extend(V._best_of(names, asked, [batch], 5, 6))) < 100
    assert found[0].column("id").to_pylist() == [0, 1, 2, 3, 4] * 10


def test_embedding_memory_does_not_follow_the_batch():
    rng = np.random.default_rng(3)
    words = pa.array([f"w{i}" for i in range(50_000)])
    rows = 10_000
    picked = words.take(pa.array(rng.integers(0, len(words), rows * 50)))
    tokens = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * 50), picked)
    seen = []
    assert peak_mb(lambda: seen.extend(x.shape[0] for x in V._slot_counts(tokens, DIMS))) < 60
    assert sum(seen) == rows and max(seen) * DIMS <= V.RUN_CELLS


def test_runs_cover_all_rows_once():
    lengths = np.array([0, 3, V.RUN_CELLS + 1, 0, 2, 2, V.RUN_CELLS - 1, 5])
    assert list(V._runs(lengths, 3)) == [(0, 2), (2, 3), (3, 6), (6, 7), (7, 8)]
    assert list(V._runs(np.array([], int), 3)) == []


@pytest.mark.parametrize("slice_bytes", [V.SLICE_BYTES, 2_000])
def test_searching_text_equals_searching_its_vectors(spark, monkeypatch, slice_bytes):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 30, rng.integers(0, 9))) for _ in range(120)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(2)
    embedder = V.HashedEmbedder(32).fit(docs)
    asked = embedder.embed(docs.where("id % 7 = 0")).withColumnRenamed("id", "query_id")
    whole = V.search(embedder.embed(docs), asked, 4, digits=6).collect()
    monkeypatch.setattr(V, "RUN_CELLS", 150)
    cut = V.search(docs, asked, 4, digits=6, slice_bytes=slice_bytes, embedder=embedder).collect()
    assert len(whole) == 4 * 18 and sorted(map(tuple, cut)) == sorted(map(tuple, whole))


def test_passages_are_found_in_every_text(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (4, "xa b")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(7, "a b"), (8, "b c"), (9, None), (10, ""), (11, "a b")], "item_id long, text string")
    assert sorted(map(tuple, passages_in_documents(docs, items).collect())) == [(1, 7), (1, 8), (1, 11), (4, 7), (4, 11)]
