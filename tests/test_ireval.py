import pytest

from corpusops.operators import ireval as E


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")], "query_id int, expected_id string")


HITS = [
    (1, 1, "a"), (1, 2, "x"),
    (2, 1, "x"), (2, 4, "b"),
    (3, 1, "x"), (3, 6, "c"),
    (4, 1, "y"), (4, 2, "d"), (4, 3, "d"),
]  # query 5 has none


def test_log_and_summary(spark, labelled):
    hits = spark.createDataFrame(HITS, "query_id int, rank int, id string")
    log = E.retrieval_log(labelled, hits)
    rows = {r.query_id: r for r in log.collect()}
    assert [(rows[q].hit, rows[q].top1_hit, rows[q]["rank"], rows[q].reciprocal_rank) for q in range(1, 6)] == [
        (True, True, 1, 1.0),
        (False, False, 4, 0.25),
        (False, False, None, 0.0),
        (True, False, 2, 0.5),
        (False, False, None, 0.0),
    ]
    assert rows[4].retrieved == ["y", "d", "d"] and rows[5].retrieved == []
    total = E.retrieval_summary(log).first()
    assert (total.total, total.hits, total.top1_hits) == (5, 2, 1)
    assert (total.accuracy, total.top1_accuracy, total.mrr) == pytest.approx((0.4, 0.2, 0.35))
    assert total.mrr <= sum(r["rank"] is not None for r in rows.values()) / 5


def test_failures(spark, labelled):
    hits = spark.createDataFrame(HITS, "query_id int, rank int, id string")
    missed = {r.query_id: r.top_result for r in E.retrieval_failures(E.retrieval_log(labelled, hits)).collect()}
    assert missed == {2: "x", 3: "x", 5: None}
    top = E.retrieval_failures(E.retrieval_log(labelled, hits), on="top1_hit")
    assert top.count() == 4


def test_a_model_without_hits_still_counts_every_query(spark, labelled):
    hits = spark.createDataFrame([(*h, "m") for h in HITS], "query_id int, rank int, id string, model string")
    rows = {r.model: r for r in E.retrieval_summary(E.retrieval_log(labelled, hits, ["m", "n"])).collect()}
    assert (rows["m"].total, rows["m"].hits) == (5, 2)
    assert (rows["n"].total, rows["n"].hits, rows["n"].mrr) == (5, 0, 0.0)
