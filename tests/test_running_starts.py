"""Offsets from lengths, and cuts that send one number per chunk to Python."""

import pyarrow as pa

from corpusops.operators import chunking
from corpusops.plans import audits


def test_starts_are_summed_over_a_batch_at_once():
    rows = pa.array([[3, 0, 2], None, [], [5]], pa.list_(pa.int64()))
    assert chunking._running(rows).to_pylist() == [[0, 4, 5], None, [], [0]]
    assert chunking._running(rows.slice(2)).to_pylist() == [[], [0]]
    assert chunking._running(rows.slice(0, 0)).to_pylist() == []


def test_word_cuts_equal_a_plain_split_and_send_few_numbers(spark, monkeypatch):
    texts = [None, "", " " * 200, "one", "\u00e4\U0001f600\n x " * 100, "a  b " * 39, "x" * 50_000, " ".join(["w"] * 41), " ".join(["w"] * 40) + " "]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    sent, inner = [], chunking._starts
    monkeypatch.setattr(chunking, "_starts", lambda lengths: (sent.append(lengths), inner(lengths))[1])
    wanted = []
    for i, text in enumerate(texts):
        at = 0
        for nth, piece in enumerate((text or "").split(" ")):
            if nth and nth % audits.PIECES == 0:
                wanted.append((i, at))
            at += len(piece) + 1
    assert sorted(map(tuple, audits.word_cuts(table).collect())) == wanted and len(wanted) > 10
    (lengths,) = sent
    assert sum(len(r[0] or []) for r in table.select(lengths).collect()) <= len(wanted) + len(texts)
