import numpy as np
import pytest

from corpusops.operators import metrics as Q


def preds(spark, tp, fn, fp, tn, **more):
    rows = [(1, 1)] * tp + [(1, 0)] * fn + [(0, 1)] * fp + [(0, 0)] * tn
    return spark.createDataFrame(rows, "label int, predicted int")


def test_known_confusion_matrix(spark):
    row = Q.report(Q.confusion(preds(spark, 19, 14, 4, 9))).first()
    assert (row.tp, row.fn, row.fp, row.tn, row.n) == (19, 14, 4, 9, 46)
    assert row.accuracy == pytest.approx(0.6086956521739131, abs=1e-15)
    assert row.balanced_accuracy == pytest.approx(0.6340326340326341, abs=1e-15)
    assert row.f1 == pytest.approx(0.6785714285714286, abs=1e-15)
    assert row.precision == pytest.approx(0.8260869565217391, abs=1e-15)
    assert row.recall == pytest.approx(0.5757575757575758, abs=1e-15)
    assert row.majority_baseline_accuracy == pytest.approx(0.717391304347826, abs=1e-15)
    assert row.lift == pytest.approx(0.1340326340326341, abs=1e-15)
    assert row.specificity == pytest.approx(9 / 13)
    assert not row.barely_above_floor and not row.constant_predictor


@pytest.mark.parametrize("counts", [(5, 0, 3, 0), (0, 5, 0, 3)])
def test_constant_predictors_score_one_half(spark, counts):
    row = Q.report(Q.confusion(preds(spark, *counts))).first()
    assert row.balanced_accuracy == 0.5 and row.constant_predictor and row.barely_above_floor
    assert row.precision == (counts[0] / 8 if counts[0] else 0)


def test_an_absent_class_drops_out_of_balanced_accuracy(spark):
    row = Q.report(Q.confusion(preds(spark, 3, 1, 0, 0))).first()
    assert row.balanced_accuracy == 0.75 and row.specificity is None
    row = Q.report(Q.confusion(preds(spark, 0, 0, 0, 2))).first()
    assert (row.recall, row.f1, row.precision, row.balanced_accuracy) == (0, 0, 0, 1.0)


def test_fold_summary_is_not_the_mean_when_folds_differ(spark):
    folds = [(0, 1, 1), (0, 1, 0), (0, 0, 0), (1, 1, 1), (1, 0, 1), (1, 0, 0), (1, 0, 0), (2, 1, 1)]
    df = spark.createDataFrame(folds, "fold int, label int, predicted int")
    row = Q.fold_summary(Q.confusion(df, "fold")).first()
    scores = [(0.5 + 1) / 2, (1 + 2 / 3) / 2, 1.0]
    assert row.folds == 3
    assert row["mean"] == pytest.approx(np.mean(scores)) and row["std"] == pytest.approx(np.std(scores))
    assert row.pooled == pytest.approx((3 / 4 + 3 / 4) / 2)


def test_category_order(spark):
    rows = [("b", 1, 1), ("b", 1, 0), ("a", 0, 0), ("c", 0, 1), ("d", 1, 0), ("d", 1, 1)]
    df = spark.createDataFrame(rows, "kind string, label int, predicted int")
    worst = Q.by_category(df, "kind").orderBy("pos").collect()
    assert [(r.category, r.correct, r.total) for r in worst] == [("c", 0, 1), ("b", 1, 2), ("d", 1, 2), ("a", 1, 1)]
    named = Q.by_category(df, "kind", worst_first=False).orderBy("pos").collect()
    assert [r.category for r in named] == ["a", "b", "c", "d"]


def test_score_report_names(spark):
    rows = {(r.mark, r.predicted_name, r.expected_name) for r in Q.score_report(preds(spark, 1, 1, 1, 1)).collect()}
    assert rows == {("PASS", "buggy", "buggy"), ("FAIL", "clean", "buggy"), ("FAIL", "buggy", "clean"), ("PASS", "clean", "clean")}
