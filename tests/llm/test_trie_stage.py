"""The pipeline's near copies come from the trie join first, and from shingles where fingerprints lie apart."""

import corpus_pipeline
from corpusops.llm import near_copies

SF = "/root/testdata/sf0.001"


def test_the_trie_join_links_near_copies_by_itself(spark, monkeypatch):
    body = [f"b{i}" for i in range(1500)]
    texts = [" ".join(body[:700] + [f"own{i}"] + body[701:]) for i in range(4)] + [" ".join(f"other{i}" for i in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(near_copies, "grouped", lambda rows, *rest: spark.createDataFrame([], near_copies.TOLD))
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert kept == [0, 4]
