"""Rows on which results once went wrong."""

import pathlib
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
import corpusops
from corpusops.llm import bit_sliced, byte_conv, hilbert_search, prefix_trees, sparse_suffix, weak_labels, words
from corpusops.llm.repeats import keyed

SF = "/root/testdata/sf0.01"


def seq(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_many_texts_under_one_id_or_none_keep_their_own_words(spark):
    # some two in 32,768 once shared a tag
    rows = [(1, seq("s", 50))] + [row for i in range(3000) for row in ((None, seq("u", 60) + f" m{i}"), (7, seq("u", 60) + f" n{i}"))] + [(None, seq("s", 50) + " tail")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for drop in (prefix_trees.drop_repeats, sparse_suffix.drop_passages):
        got = {(r.doc_id, r.text): r.n_removed for r in drop(table).select("rest.doc_id", "out.text", "out.n_removed").collect()}
        assert got[(1, seq("s", 50))] == 0 and got[(None, "tail")] == 50
        for i in range(3000):
            # of rows under 7 none is smaller than the other; rows without an id come after those under 7
            assert got[(7, seq("u", 60) + f" n{i}")] == 0
            assert got[(None, f"m{i}")] == 60
    kept = corpus_pipeline.passages(spark, table, SF).collect()
    assert len(kept) == len(rows) and sum(r.text == "tail" for r in kept) == 1
    assert keyed(table, "doc_id", "text").select("tag").distinct().count() > 3000


def test_functions_travel_without_the_package(spark, tmp_path):
    # what they have computed before must not go along by name either
    texts = words.texts_of(pa.array(["one two three"]))
    expected = texts.word_hash.tolist()
    cloudpickle.register_pickle_by_value(corpusops)
    try:
        data = cloudpickle.dumps(lambda column: words.texts_of(column).word_hash.tolist())
    finally:
        cloudpickle.unregister_pickle_by_value(corpusops)
    (tmp_path / "f").write_bytes(data)
    code = "import sys, pickle, pyarrow as pa; print(pickle.load(open(sys.argv[1], 'rb'))(pa.array(['one two three']))); import importlib.util as u; assert u.find_spec('corpusops') is None"
    ran = subprocess.run([sys.executable, "-c", code, str(tmp_path / "f")], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin", "PYTHONPATH": ":".join(p for p in sys.path if p and pathlib.Path(p, "pyspark").exists())})
    assert ran.returncode == 0, ran.stderr
    assert eval(ran.stdout) == expected


def test_language_is_learned_behind_a_shared_opening(spark):
    notice = "Notice 0123456789. " * 31
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    noted = docs.withColumn("text", F.concat(F.lit(notice), "text"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = byte_conv.predict(noted, held).where("held_out").join(docs, "doc_id").where("lang is not null").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95
    assert byte_conv.predict(docs.limit(0), held).count() == 0


def test_scorer_reads_whole_texts(spark):
    base = "plain words stand here "
    long, other = base * 1200 + "tail", base * 1200 + "$$$$ #### &&&&"
    # junk of one kind and clean texts, and long texts that are junk only behind their 4096th word
    rows = [(i, base * 20 + seq(f"w{i}", 30)) for i in range(40)] + [(100 + i, "$$$ " * 30 + seq(f"j{i}", 5)) for i in range(40)]
    rows += [(200, base * 1100 + "tail"), (201, base * 1100 + "$$$ " * 9000), (202, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r[0]: r[1] for r in weak_labels.scored(docs).select("rest.doc_id", "clean").collect()}
    assert clean[200] > 0.5 > clean[201] and clean[202] >= 0.5
    told = [np.unique(weak_labels.features(words.texts_of(pa.array([t])))[1], return_counts=True) for t in (long, other)]
    assert not np.array_equal(told[0][0], told[1][0])


def test_products_beyond_64_bits_end_the_job(spark):
    big = spark.createDataFrame([(i, [1e200, 1.0]) for i in range(3)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="too large"):
        bit_sliced.top_k(big, F.col("vec_id") == 0).collect()
    # what still fits is exact
    near = spark.createDataFrame([(0, [2e6, -2e6]), (1, [2e6, 2e6]), (2, [2e6, -1e6])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in bit_sliced.top_k(near, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 256 * 256 * 6 * 10**12), (0, 2, 1, 0)]


def test_very_small_and_very_large_vectors_take_part(spark):
    rows = [(0, [1e-200, 2e-200]), (1, [1e200, 1e200]), (2, [-1.0, 0.5]), (3, [0.0, 0.0]), (4, [5e-324, 1e-323])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in hilbert_search.nearest(table, F.col("vec_id") == 0).collect()}
    assert got.keys() == {1, 2, 4}
    assert got[1] == pytest.approx(3 / 10**0.5) and got[2] == pytest.approx(0.0, abs=1e-12) and got[4] == pytest.approx(1.0)
