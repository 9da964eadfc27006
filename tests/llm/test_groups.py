"""Near copies by groups: the same components as all links give, at a cost that grows with the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusops.llm import near_copies

SF = "/root/testdata/sf0.001"


def roots_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    for u, v in pairs:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes if find(n) != n}


@pytest.mark.parametrize("whole, common", [(16, 4), (2, 2), (1, 10**6)])
def test_groups_equal_the_components_of_all_links(spark, monkeypatch, whole, common):
    monkeypatch.setattr(near_copies, "COMMON", common)
    monkeypatch.setattr(near_copies, "SAMPLE", 2)
    monkeypatch.setattr(near_copies, "TOGETHER", 50)
    draw = np.random.default_rng(7)
    notice = [f"n{i}" for i in range(25)]
    texts = []
    for n in (3, 8, 40, 90, 90, 160):
        base = [f"w{i}" for i in draw.integers(0, 10**6, n)]
        for edits in (0, 1, 1, 1, 1, 2, 2, 2, 3, 4, 6):
            copy = list(base)
            for at in draw.integers(0, n, edits):
                copy[at] = f"X{draw.integers(0, 10**6)}"
            texts.append(" ".join(notice + copy))
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sets = [near_copies.shingle_set(t, 5) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if near_copies.similar(sets[i], sets[j])]
    assert len(near) > 60
    assert {r.node: r.group for r in near_copies.groups(rows, whole=whole).collect()} == roots_of(near, range(len(texts)))


def test_a_large_group_of_near_copies_costs_links_in_proportion(spark, monkeypatch):
    body = [f"b{i}" for i in range(60)]
    texts = [" ".join([*body[: 58 + i % 3], f"own{i}", *body[58 + i % 3 :]]) for i in range(5000)]
    compared = []
    inner = near_copies.verified
    monkeypatch.setattr(near_copies, "verified", lambda pairs, *rest: (compared.append(pairs.count()), inner(pairs, *rest))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert [r.doc_id for r in kept] == [0]
    # all pairs would be 12 million
    assert sum(compared) < 40 * len(texts), compared


def test_common_shingles_are_told_by_a_bitmap(spark):
    rows = spark.createDataFrame([(i, " ".join(f"s{j}" for j in range(9)) + f" t{i}") for i in range(400)], "node long, text string")
    packed = near_copies.common_shingles(rows, 5)
    known = np.unpackbits(packed, bitorder="little")
    import pyarrow as pa

    from corpusops.llm.words import texts_of

    _, h = near_copies.shingles(texts_of(pa.array([" ".join(f"s{j}" for j in range(9))])), 5)
    assert known.sum() == len(h) == 5 and known[(h % np.uint64(near_copies.BITMAP)).astype(np.int64)].all()
    assert not near_copies.common_shingles(rows.limit(0), 5).any()
    assert near_copies.groups(rows.limit(0)).count() == 0
    assert near_copies.groups(rows.where(F.lit(False))).count() == 0
