"""Binary classification reports. Every table of rows is reduced once to counts, which then add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# What a constant predictor scores, and the lift below which a model is doubted.
FLOOR = 0.5
SMALL_LIFT = 0.05


def confusion(preds: DataFrame, *keys: str) -> DataFrame:
    """tp, fn, fp, tn of (label, predicted) per key."""
    return preds.groupBy(*keys).agg(*_outcomes())


def _outcomes() -> list[Column]:
    pos, said = F.col("label") == 1, F.col("predicted") == 1
    kinds = {"tp": pos & said, "fn": pos & ~said, "fp": ~pos & said, "tn": ~pos & ~said}
    return [F.count_if(kind).alias(name) for name, kind in kinds.items()]


def _ratio(part: Column, *whole: Column) -> Column:
    return F.try_divide(part.cast("double"), sum(whole[1:], whole[0]).cast("double"))


def _counts() -> tuple[Column, ...]:
    return F.col("tp"), F.col("fn"), F.col("fp"), F.col("tn")


def balanced_accuracy() -> Column:
    """Mean recall over the classes the labels hold."""
    tp, fn, fp, tn = _counts()
    recalls = F.array_compact(F.array(_ratio(tn, tn, fp), _ratio(tp, tp, fn)))
    summed = F.aggregate(recalls, F.lit(0.0), lambda a, r: a + r)
    return F.try_divide(summed, F.size(recalls))


def report(counts: DataFrame) -> DataFrame:
    """All scores of each row of ``confusion``; undefined precision, recall and F1 are 0."""
    tp, fn, fp, tn = _counts()
    zero = F.lit(0.0)
    scores = {
        "n": tp + fn + fp + tn,
        "accuracy": _ratio(tp + tn, tp, fn, fp, tn),
        "balanced_accuracy": balanced_accuracy(),
        "precision": F.coalesce(_ratio(tp, tp, fp), zero),
        "recall": F.coalesce(_ratio(tp, tp, fn), zero),
        "f1": F.coalesce(_ratio(2 * tp, 2 * tp, fp, fn), zero),
        "specificity": _ratio(tn, tn, fp),
        "majority_baseline_accuracy": _ratio(F.greatest(tp + fn, tn + fp), tp, fn, fp, tn),
        "constant_predictor": ((tp + fp) == 0) | ((fn + tn) == 0),
    }
    scored = counts.withColumns(scores)
    lift = F.col("balanced_accuracy") - FLOOR
    return scored.withColumns({"lift": lift, "barely_above_floor": lift < SMALL_LIFT})


def fold_summary(fold_counts: DataFrame) -> DataFrame:
    """Mean and population deviation of the folds' balanced accuracy, and the pooled score.

    Takes ``confusion(preds, "fold")``: pooled counts are the folds' sums, so rows are read once.
    """
    summed = [F.sum(c).alias(c) for c in ("tp", "fn", "fp", "tn")]
    scored = fold_counts.withColumn("score", balanced_accuracy())
    rolled = scored.agg(
        F.count("*").alias("folds"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), *summed
    )
    return rolled.select("folds", "mean", "std", balanced_accuracy().alias("pooled"))


def fold_and_pooled(preds: DataFrame, fold: str = "fold") -> DataFrame:
    """All scores per fold and, with scope ``pooled`` and no fold, over all of them: one pass and one shuffle of counts."""
    counts = preds.groupingSets([[fold], []], fold).agg(F.grouping(fold).alias("_all"), *_outcomes())
    scope = F.when(F.col("_all") == 1, "pooled").otherwise("fold")
    return report(counts.withColumn("scope", scope).drop("_all"))


def by_category(preds: DataFrame, category: str, worst_first: bool = True) -> DataFrame:
    """correct/total per category with its place: worst ratio first, or by name.

    The one-task ranking sees one row per category, not the predictions.
    """
    counts = preds.groupBy(F.col(category).alias("category")).agg(
        F.count_if(F.col("predicted") == F.col("label")).alias("correct"), F.count("*").alias("total")
    )
    ratio = counts.withColumn("ratio", _ratio(F.col("correct"), F.col("total")))
    order = ["ratio", "category"] if worst_first else ["category"]
    return ratio.withColumn("pos", F.row_number().over(W.orderBy(*order)))


def score_report(preds: DataFrame) -> DataFrame:
    """PASS or FAIL with label names, per scored row."""
    # Label names.
    name = F.create_map(F.lit(0), F.lit("clean"), F.lit(1), F.lit("buggy"))
    correct = F.col("predicted") == F.col("label")
    return preds.withColumns(
        {
            "mark": F.when(correct, "PASS").otherwise("FAIL"),
            "predicted_name": name[F.col("predicted")],
            "expected_name": name[F.col("label")],
        }
    )
