import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from corpusops.operators import classify as L
from corpusops.operators import splits


def texts(spark, n=120):
    rows = [(i, f"{'good fine' if i % 4 else 'bad poor'} word{i % 7} word{i % 5}", int(i % 4 > 0), f"g{i % 12}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string, label int, grp string")


def test_tokens_are_cut_after_the_limit(spark):
    df = spark.createDataFrame([("A_b (c1)+=é  " * 60,), ("",)], "text string")
    long, empty = [r[0] for r in df.select(L.tokens(F.col("text"))).collect()]
    assert long[:7] == ["a_b", "(", "c1", ")", "+", "=", "é"] and len(long) == 128
    assert empty == []


def test_fit_predict_save_and_reload(spark, tmp_path):
    ready = L.featurize(texts(spark), "text")
    model = L.fit(ready)
    scored = L.predict(model, ready)
    assert scored.where("predicted <> label").count() == 0
    assert scored.where("confidence <= 0.5 OR confidence > 1").count() == 0
    model.write().overwrite().save(str(tmp_path / "model"))
    again = L.predict(PipelineModel.load(str(tmp_path / "model")), ready)
    pick = ["id", "predicted", F.round("confidence", 9)]
    assert sorted(map(tuple, again.select(*pick).collect())) == sorted(map(tuple, scored.select(*pick).collect()))


def test_training_without_a_class_is_an_error(spark):
    with pytest.raises(ValueError, match="class"):
        L.fit(L.featurize(texts(spark).where("label = 1"), "text"))


def test_out_of_fold_predicts_every_row_once_with_a_model_that_has_not_seen_it(spark):
    folded = splits.group_kfold(texts(spark), "grp", folds=3)
    predicted = L.out_of_fold(folded, "text", folds=3, slots=1 << 10)
    assert predicted.count() == 120 == predicted.select("id").distinct().count()
    assert predicted.where("predicted IS NULL").count() == 0
    one = splits.group_kfold(texts(spark), "grp", folds=3).where("fold <> 1")
    ready = L.featurize(one, "text", 1 << 10)
    held = L.featurize(splits.group_kfold(texts(spark), "grp", folds=3).where("fold = 1"), "text", 1 << 10)
    alone = {r.id: round(r.confidence, 6) for r in L.predict(L.fit(ready), held).collect()}
    assert alone == {r.id: round(r.confidence, 6) for r in predicted.where("fold = 1").collect()}


def test_fresh_code_takes_normal_form_first(spark):
    code = [(f"def f{i}(a):\n    return a {'+' if i % 2 else '-'} {i % 3}", i % 2) for i in range(40)]
    train = spark.createDataFrame(code, "code string, label int")
    model = L.fit(L.featurize(train, "code"))
    fresh = spark.createDataFrame(
        [("def g( a ):  # note\n    return a   + 1", 1, "x"), ("def g(a): return a-1", 1, "y")], "code string, label int, category string"
    )
    marks = {r.category: (r.mark, r.predicted_name) for r in L.score_fresh(model, fresh).collect()}
    assert marks == {"x": ("PASS", "buggy"), "y": ("FAIL", "clean")}


def test_argmax_softmax_and_loss(spark):
    rows = [([1.0, 2.0], 1), ([2.0, 2.0], 0), ([1000.0, 0.0], 1), ([-1.0, -3.0], 0)]
    df = spark.createDataFrame(rows, "scores array<double>, label int")
    scores = F.col("scores")
    got = df.select(
        L.argmax(scores).alias("a"), L.softmax(scores).alias("p"), L.confidence(scores).alias("c"), L.log_loss(F.col("label"), scores).alias("l")
    ).collect()
    assert [r.a for r in got] == [1, 0, 0, 0]
    for (s, label), r in zip(rows, got):
        shifted = [math.exp(x - max(s)) for x in s]
        assert r.p == pytest.approx([x / sum(shifted) for x in shifted]) and r.c == pytest.approx(max(r.p))
    assert [r.l for r in got] == pytest.approx([math.log(1 + math.exp(-1)), math.log(2), 1000.0, math.log(1 + math.exp(-2))])
    weights = splits.with_class_weight(df, splits.class_weights(df))
    row = L.weighted_log_loss(weights).first()
    assert row.n == 4 and row.log_loss == pytest.approx(sum(r.l for r in got) / 4)


def test_best_checkpoint_is_the_earliest_of_the_best(spark):
    rows = [(1, 0.5, 0.6), (2, 0.5, 0.7), (3, 0.9, 0.7), (2, None, None)]
    history = spark.createDataFrame(rows, "epoch int, eval_accuracy double, eval_balanced_accuracy double")
    assert L.eval_history(history).count() == 3
    assert L.best_checkpoint(history).first().epoch == 2
