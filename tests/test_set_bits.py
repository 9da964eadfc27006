"""Candidates that only share some shingles by chance are turned down by bits, before texts or sets travel."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from corpusops.llm import near_copies, simhash_trie
from corpusops.operators import set_bits, similarity
from corpusops.session import durable, shuffles_go


def bits_of(sets):
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return set_bits.parity_bits(row, np.array([x for s in sets for x in s], np.int64), len(sets)).to_pylist()


def test_bits_never_turn_similar_sets_down():
    draw = random.Random(5)
    turned = unlike = 0
    for n in (0, 1, 4, 9, 60, 64, 65, 127, 130, 500, 3000):
        whole = [draw.getrandbits(64) - (1 << 63) for _ in range(n)]
        for _ in range(40):
            gone = draw.randrange(0, n // 6 + 2)
            other = whole[gone:] + [draw.getrandbits(64) - (1 << 63) for _ in range(draw.randrange(0, n // 5 + 2))]
            a, b = set(whole), set(other)
            near = 5 * len(a & b) >= 4 * len(a | b)
            x, y = bits_of([a, b])
            told = set_bits.may_be_similar(x, len(a), y, len(b), 4, 5)
            assert told == set_bits.may_be_similar(y, len(b), x, len(a), 4, 5)
            assert told or not near
        far = [draw.getrandbits(64) - (1 << 63) for _ in range(n)]
        x, y = bits_of([set(whole), set(far)])
        unlike += n >= 60
        turned += n >= 60 and not set_bits.may_be_similar(x, n, y, n, 4, 5)
    assert turned == unlike
    assert bits_of([]) == [] and bits_of([set(), {7}])[0] == bytes(8)


def by_chance(n):
    # rows of texts whose rare shingles are all drawn from few: nearly all texts meet, none is similar to another
    draw = random.Random(3)
    notes = [" ".join(f"n{i}w{j}" for j in range(5)) for i in range(40)]
    return [(i, " ".join(f"{note} x{i}y{k}" for k, note in enumerate(draw.sample(notes, 12)))) for i in range(n)]


def test_near_copies_compare_few_of_the_texts_that_meet_by_chance(spark, monkeypatch):
    rows = by_chance(150)
    body = [f"b{i}" for i in range(120)]
    rows += [(1000 + i, " ".join(body[:60] + [f"own{i}"] + body[60:])) for i in range(3)]
    compared, verified = [], near_copies.verified
    monkeypatch.setattr(near_copies, "verified", lambda pairs, *rest: (compared.append(pairs.count()), verified(pairs, *rest))[1])
    table = spark.createDataFrame(rows, "node long, text string")
    assert {r.node: r.group for r in near_copies.groups(table).collect()} == {1001: 1000, 1002: 1000}
    assert sum(compared) < 30, compared


def test_the_leakage_audit_compares_few_of_the_texts_that_meet_by_chance(spark, monkeypatch):
    rows = [(i, t, "test" if i % 3 == 0 else "train") for i, t in by_chance(150)]
    body = [f"b{i}" for i in range(120)]
    rows += [(1000 + i, " ".join(body[:60] + [f"own{i}"] + body[60:]), "test" if i else "train") for i in range(3)]
    compared, verified = [], similarity._verified
    monkeypatch.setattr(similarity, "_verified", lambda pairs, sets: (compared.append(pairs.count()), verified(pairs, sets))[1])
    leaked = similarity.leaked_near(spark.createDataFrame(rows, "doc_id long, text string, split string"), "doc_id", "text")
    assert sorted(r.doc_id for r in leaked.where("leaks").collect()) == [1001, 1002]
    assert compared[1] < 30, compared


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def left_over(spark, before):
    # files go in the background
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            return left
        time.sleep(0.2)
    return left


def test_what_the_steps_dealt_out_goes_with_them(spark):
    before, held = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with shuffles_go(spark):
        kept = durable(spark.range(1000).repartition(4, F.col("id") % 7))
    assert kept.count() == 1000
    docs = spark.createDataFrame([(i, t) for i, t in by_chance(40)], "doc_id long, text string")
    gone = simhash_trie.deduplicated(docs)
    rows = similarity.leaked_near(docs.withColumn("split", F.when(F.col("doc_id") < 9, "test").otherwise("train")), "doc_id", "text")
    assert len(left_over(spark, before)) <= 3, "what count() dealt out, which is no step's"
    assert gone.count() == 40 and rows.count() == 9
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == held
