"""Near-duplicate leakage, cut points, search in cells and epochs against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusops.operators import cells, classify, intervals, metrics, similarity, splits
from corpusops.operators import vectors as V


def shingles(text, size=5):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def near_by_brute_force(rows):
    sets = {i: shingles(t) for i, t, _ in rows}
    out = []
    for i, _, side in rows:
        if side != "test":
            continue
        mine = sets[i]
        if not mine:
            out.append((i, None, 0, False))
            continue
        train = [j for j, _, s in rows if s == "train"]
        leaks = any(5 * len(mine & sets[j]) >= 4 * len(mine | sets[j]) for j in train if sets[j])
        out.append((i, min(j for j in sets if sets[j] == mine), sum(sets[j] == mine for j in train), leaks))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = draw.choices(words, k=draw.choice([3, 12, 60]))
        for _ in range(draw.choice([1, 2, 4])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 3, 8])):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(" ".join(copy))
    rows += [None, "", "  \n", "one", "ONE", "notice " * 30]
    # a passage that most texts begin with
    notice = " ".join(f"n{i}" for i in range(30))
    rows += [f"{notice} {r}" for r in rows[:60] if r]
    draw.shuffle(rows)
    return [(i, t, "test" if i % 3 == 0 else "train") for i, t in enumerate(rows)]


def test_near_leaks_equal_brute_force(spark, texts):
    table = spark.createDataFrame([(i, t, s, "x") for i, t, s in texts], "doc_id long, text string, split string, shingles string")
    got = similarity.leaked_near(table, "doc_id", "text").select("doc_id", "class_id", "same_rows", "leaks").collect()
    wanted = near_by_brute_force(texts)
    assert sorted(map(tuple, got)) == wanted
    assert sum(r[3] for r in wanted) > sum(r[2] > 0 for r in wanted) > 0
    rate = similarity.near_leakage(similarity.leaked_near(table, "doc_id", "text")).first()
    assert (rate.test_rows, rate.leaked_rows) == (len(wanted), sum(r[3] for r in wanted))
    assert similarity.leaked_near(table.limit(0), "doc_id", "text").count() == 0


def test_a_hot_group_of_near_copies_costs_one_comparison_each(spark, monkeypatch):
    # 3,000 texts that differ in one word each: 2 million pairs between the sides
    body = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(body[:60] + [f"own{i}"] + body[60:]), "test" if i % 3 == 0 else "train") for i in range(3000)]
    compared = []
    verified = similarity._verified
    monkeypatch.setattr(similarity, "_verified", lambda pairs, sets: (compared.append(pairs.count()), verified(pairs, sets))[1])
    leaked = similarity.leaked_near(spark.createDataFrame(rows, "doc_id long, text string, split string"), "doc_id", "text")
    assert leaked.where("leaks").count() == 1000 and leaked.where("same_rows > 0").count() == 0
    assert compared == [1000, 0]


def test_shingle_sets_are_not_written(spark, monkeypatch):
    # 300 unlike texts: what is written to find near ones stays below one copy of all their shingles
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(200)), "test" if i % 3 == 0 else "train") for i in range(300)]
    written, durable = [], similarity.durable

    def counted(df, *by):
        kept = durable(df, *by)
        shingles = [F.size(c) if kind.startswith("array") else F.lit(1) for c, kind in kept.dtypes if kind.startswith("array") or c == "shingle"]
        written.append(kept.agg(F.sum(sum(shingles, F.lit(0)))).first()[0] or 0)
        return kept

    monkeypatch.setattr(similarity, "durable", counted)
    leaked = similarity.leaked_near(spark.createDataFrame(rows, "doc_id long, text string, split string"), "doc_id", "text")
    assert leaked.count() == 100 and leaked.where("leaks").count() == 0
    assert 0 < sum(written) < 300 * 196, written


def test_cuts_inside_equal_brute_force(spark):
    draw = random.Random(6)
    units = [(k, a, a + draw.choice([0, 1, 5, 300, 40_000, 9_000_000])) for k in ("a", "b", "c", None) for a in (draw.randrange(0, 50_000) for _ in range(40))]
    units += [("a", 5, 5), ("a", 9, 3), ("a", 0, 100), ("a", 0, 100), ("b", None, 4)]
    cuts = [(k, draw.randrange(0, 9_500_000)) for k in ("a", "b", None) for _ in range(400)] + [("a", x) for x in (0, 1, 50, 50, 99, 100, 1023, 1024, 1025, 2048)]
    got = Counter(
        (r["file"], r.s, r.e, r.cuts_inside)
        for r in intervals.cuts_inside(
            spark.createDataFrame(units, "file string, s long, e long"), spark.createDataFrame(cuts, "file string, at long"), "file", start="s", end="e", width=64
        ).collect()
    )
    wanted = Counter((k, s, e, 0 if k is None or s is None else sum(f == k and s < x < e for f, x in cuts)) for k, s, e in units)
    assert got == wanted


def test_one_unit_over_many_bins_meets_few_rows(spark, capsys):
    units = spark.createDataFrame([("a", 3, 3_000_000_000)], "file string, char_start long, char_end long")
    cuts = spark.range(200_000).select(F.lit("a").alias("file"), (F.col("id") * 7919).alias("at"))
    found = intervals.cuts_inside(units, cuts, "file")
    assert found.first().cuts_inside == 199_999
    found.explain("simple")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    low, high = F.lit(1), F.lit(3_000_000_000 // 1024)
    assert 20 < len(spark.range(1).select(intervals._nodes(low, high)).first()[0]) < 64


def clustered(spark, n=4000, dims=8):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, dims)) * 50
    rows = [(i, [float(x) for x in centres[i % 20] + draw.normal(size=dims)], str(i)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, embedding array<double>, name string")


def test_cells_find_what_the_whole_scan_finds_and_read_few_partitions(spark, tmp_path):
    rows, table = clustered(spark)
    queries = spark.createDataFrame([(i, [x + 0.1 for x in rows[i * 37][1]]) for i in range(4)], "query_id long, embedding array<double>")
    held, told = cells.load_cells(spark, cells.save_cells(table, str(tmp_path / "index"), cells=20))
    assert held.count() == len(rows) and told.count() == 20
    found = cells.search_cells(held, told, queries, 5)
    exact = V.search(table, queries, 5)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.select(*found.columns).collect()))
    read = {r.cell for r in held.select("cell", F.input_file_name().alias("f")).distinct().collect()}
    wanted = cells._in_cells(held.select("id", F.col("embedding").alias("vector"), "cell"), {3: [0], 7: [0]}, queries.select("query_id", F.col("embedding").alias("vector")).toArrow(), 5, exact.select("query_id", "id", "distance").schema)
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="no rows"):
        cells.save_cells(table.limit(0), str(tmp_path / "index"))
    assert cells.load_cells(spark, str(tmp_path / "index"))[0].count() == len(rows)
    assert len(read) == 20 and "PartitionFilters: [cell" in plan
    assert len({f for f in wanted.inputFiles()}) <= len(held.inputFiles())


@pytest.mark.parametrize("k", [1, 3, 50])
def test_cells_with_ties_strays_and_few_rows(spark, tmp_path, k):
    rows = [(i, [float(i % 3), 0.0], None) for i in range(30)] + [(90, [float("nan"), 0.0], None), (91, [None, 1.0], None), (92, None, None)]
    table = spark.createDataFrame(rows[:32], "id long, embedding array<double>, note string")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.4, 7.0])], "query_id long, embedding array<double>")
    held, told = cells.load_cells(spark, cells.save_cells(table, str(tmp_path / "index"), cells=4))
    columns = ["query_id", "rank", "id", "distance"]
    assert sorted(map(tuple, cells.search_cells(held, told, queries, k).select(*columns).collect())) == sorted(map(tuple, V.search(table, queries, k).select(*columns).collect()))


def test_epochs_learn_and_the_best_one_is_kept(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(["good", "fine", "calm"] if i % 2 else ["bad", "poor", "loud"], k=6) + draw.choices(["x", "y", "z"], k=6)), i % 2, "test" if i % 5 == 0 else "train") for i in range(400)]
    fit = classify.fit_epochs(spark.createDataFrame(rows, "id long, text string, label int, split string"), "text", epochs=5, rate=20.0, slots=64)
    history = fit.history.orderBy("epoch").collect()
    assert [r.epoch for r in history] == [1, 2, 3, 4, 5] and history[-1].eval_accuracy > 0.9
    losses = [r.eval_loss for r in history]
    assert losses == sorted(losses, reverse=True)
    assert len(fit.weights) == 5 and fit.best().shape == (65,)
    with pytest.raises(ValueError, match="no training rows"):
        classify.fit_epochs(spark.createDataFrame(rows[1::2], "id long, text string, label int, split string"), "text", epochs=1, slots=8)


def test_an_epoch_is_a_gradient_step(spark):
    rows = [(1, "a b", 1, "train"), (2, "a a c", 0, "train"), (3, "c", 0, "train"), (4, "a", 1, "test"), (5, None, 0, "test")]
    table = spark.createDataFrame(rows, "id long, text string, label int, split string")
    fit = classify.fit_epochs(table, "text", epochs=2, rate=0.5, slots=8)
    counts = {r.id: np.array(r.counts.toArray()) for r in classify.md5_counts(table, "text", 8).collect()}
    x = np.array([np.append(counts[i] / max(1, counts[i].sum()), 1) for i in (1, 2, 3)])
    y, share = np.array([1, 0, 0]), np.array([3 / 2, 3 / 4, 3 / 4])
    w = np.zeros(9)
    for step in range(2):
        w = w - 0.5 * ((share * (1 / (1 + np.exp(-x @ w)) - y)) @ x) / share.sum()
        assert np.allclose(fit.weights[step], w, atol=1e-8)


def test_folds_and_pooled_from_one_exchange(spark, capsys):
    rows = spark.createDataFrame([(i % 3, i % 2, (i // 2) % 2) for i in range(60)], "fold int, label int, predicted int")
    scored = metrics.fold_and_pooled(rows)
    scored.explain("simple")
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
    whole = {r.fold: r for r in scored.collect()}
    assert whole[None].scope == "pooled" and whole[None].n == 60 and len(whole) == 4
    assert whole[None].tp == sum(whole[f].tp for f in range(3))


def test_softmax_and_loss_over_awkward_scores(spark):
    rows = [([1000.0, 999.0], 0), ([-1000.0, 5.0], 1), ([0.0, 0.0], 1)]
    table = spark.createDataFrame(rows, "scores array<double>, label int")
    got = table.select(classify.softmax(F.col("scores")).alias("p"), classify.log_loss(F.col("label"), F.col("scores")).alias("l")).collect()
    for (scores, label), r in zip(rows, got):
        powers = np.exp(np.array(scores) - max(scores))
        assert np.allclose(r.p, powers / powers.sum()) and np.isclose(r.l, -np.log(powers[label] / powers.sum()))


def test_splits_feed_the_audit(spark):
    docs = spark.createDataFrame([(i, f"source{i % 4}", f"text number {i // 2} with some more words") for i in range(40)], "doc_id long, source string, text string")
    assert similarity.leaked_near(splits.group_holdout(docs, "source"), "doc_id", "text").count() == 10
