"""Weighted text classification on Spark ML, out-of-fold prediction, and scores from logits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.operators import splits
from corpusops.operators.metrics import confusion, report, score_report
from corpusops.operators.mutation import normal_form
from corpusops.session import durable

# Tokens kept per text, and the training budget.
MAX_TOKENS = 128
ITERATIONS = 15


def tokens(text: Column, limit: int = MAX_TOKENS) -> Column:
    """Words, numbers and single symbols in order, cut after ``limit`` as the model's input is."""
    token = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
    # tokens and white space make up a text, so its first tokens are found without reading on
    head = F.regexp_extract(F.lower(text), rf"^(?:\s*+(?:{token})){{1,{limit}}}", 0)
    return F.slice(F.regexp_extract_all(head, F.lit(token), F.lit(0)), 1, limit)


def featurize(rows: DataFrame, text: str, slots: int = 1 << 14) -> DataFrame:
    """Hashed token counts; stateless, so it is done once for all folds."""
    counted = HashingTF(inputCol="tokens", outputCol="counts", numFeatures=slots)
    return counted.transform(rows.withColumn("tokens", tokens(F.col(text)))).drop("tokens")


def md5_counts(rows: DataFrame, text: str, slots: int = 64) -> DataFrame:
    """Token counts by md5 slot, which any engine can repeat; a null text has none."""
    hits = F.transform(tokens(F.coalesce(F.col(text), F.lit(""))), lambda t: (F.conv(F.substring(F.md5(t), 1, 6), 16, 10).cast("int") % slots).cast("string"))
    # one step per token, where a fold over arrays takes one per token and slot
    counted = CountVectorizerModel.from_vocabulary([str(s) for s in range(slots)], inputCol="_hits", outputCol="counts")
    return counted.transform(rows.withColumn("_hits", hits)).drop("_hits")


def weighted_bayes(smoothing: float = 1.0) -> Pipeline:
    """Multinomial naive Bayes over ``counts``, weighted by class: one aggregation, no iterations."""
    bayes = NaiveBayes(
        featuresCol="counts", labelCol="label", weightCol="weight", smoothing=smoothing,
        probabilityCol="probabilities", rawPredictionCol="logits", predictionCol="said",
    )
    return Pipeline(stages=[bayes])


def weighted_logistic(iterations: int = ITERATIONS, reg: float = 0.01) -> Pipeline:
    """IDF and a class-weighted logistic loss over ``counts``; both are fitted on the train side only."""
    return Pipeline(
        stages=[
            IDF(inputCol="counts", outputCol="features"),
            LogisticRegression(
                featuresCol="features", labelCol="label", weightCol="weight", maxIter=iterations, regParam=reg,
                probabilityCol="probabilities", rawPredictionCol="logits", predictionCol="said",
            ),
        ]
    )


def fit(train: DataFrame, estimator: Pipeline | None = None) -> PipelineModel:
    """Weights come from the train side's class counts; a class without rows is an error."""
    weights = {r["label"]: r["weight"] for r in splits.class_weights(train).collect()}
    absent = [label for label, weight in weights.items() if weight is None]
    if absent:
        raise ValueError(f"no training rows of class {absent}")
    # two numbers: a literal keeps the plan that every iteration reads free of joins
    weight = F.when(F.col("label") == 1, weights[1]).otherwise(weights[0])
    model = (estimator or weighted_logistic()).fit(train.withColumn("weight", weight))
    for stage in model.stages:
        # a training summary holds the session, which can't go along with tasks once the session observes a write
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(train.sparkSession.sparkContext._jvm.scala.Option.empty())
    return model


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``predicted`` and the ``confidence`` in it."""
    scored = model.transform(rows).withColumn("p", vector_to_array("probabilities"))
    added = {"predicted": argmax(F.col("p")), "confidence": F.array_max("p")}
    return scored.withColumns(added).select(*rows.columns, *added)


def score_fresh(model: PipelineModel, examples: DataFrame, slots: int = 1 << 14) -> DataFrame:
    """PASS or FAIL with names and confidence for (code, label, category) the model has not seen.

    Code takes the normal form that the training examples have.
    """
    ready = examples.withColumn("code", normal_form(F.col("code")))
    return score_report(predict(model, featurize(ready, "code", slots)).drop("counts"))


def out_of_fold(
    rows: DataFrame, text: str, folds: int = splits.FOLDS, slots: int = 1 << 14,
    estimator: Pipeline | None = None, features: Callable[[DataFrame, str, int], DataFrame] = featurize,
) -> DataFrame:
    """Predict each fold with a model that has seen only the others; every row is predicted once.

    Features are cut to a shared table partitioned by fold, as each of the k fits reads its own folds
    several times. The fits are independent, so their jobs are submitted side by side.
    """
    return _cross_fitted(durable(features(rows, text, slots), "fold"), folds, estimator)


def _cross_fitted(ready: DataFrame, folds: int, estimator: Pipeline | None) -> DataFrame:
    def held_out(fold: int) -> DataFrame:
        model = fit(ready.where(F.col("fold") != fold), estimator)
        return predict(model, ready.where(F.col("fold") == fold)).drop("counts")

    with ThreadPoolExecutor(folds) as pool:
        parts = list(pool.map(inheritable_thread_target(ready.sparkSession)(held_out), range(folds)))
    return reduce(DataFrame.unionByName, parts)


def tuning_history(
    rows: DataFrame, text: str, candidates: dict[int, Pipeline], folds: int = splits.FOLDS, slots: int = 1 << 14,
    features: Callable[[DataFrame, str, int], DataFrame] = featurize,
) -> DataFrame:
    """One row of scores per numbered estimator, from its out-of-fold predictions of rows with a ``fold``.

    Features are made once for all candidates; each is reduced to its counts before the next is fitted.
    """
    ready = durable(features(rows, text, slots), "fold")
    counts = [
        durable(confusion(_cross_fitted(ready, folds, estimator)).withColumn("epoch", F.lit(number)))
        for number, estimator in candidates.items()
    ]
    scored = report(reduce(DataFrame.unionByName, counts))
    return scored.select("epoch", *[F.col(c).alias(f"eval_{c}") for c in ("accuracy", "balanced_accuracy", "f1")])


# ---------------------------------------------------------------- epochs


@dataclass
class EpochFit:
    """Scores of the test side after each epoch, and the weights each epoch ended with (the last one is the bias)."""

    history: DataFrame
    weights: list[np.ndarray]

    def best(self) -> np.ndarray:
        """Weights of the epoch that ``best_checkpoint`` names."""
        return self.weights[best_checkpoint(self.history).first()["epoch"] - 1]


def _shares(column: pa.Array, slots: int) -> np.ndarray:
    """Rows of counts as shares of their sum, and a one for the bias."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), slots)
    return np.concatenate([values / np.maximum(1.0, values.sum(axis=1, keepdims=True)), np.ones((len(values), 1))], axis=1)


def _pass(ready: DataFrame, slots: int, weights: np.ndarray, class_weight: tuple[float, float]) -> dict[int, float]:
    """One scan: the train side's gradient by slot, and the test side's counts and losses under negative numbers.

    Tasks send one row per number, which the shuffle adds up before the driver sees them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(slots + 1 + len(TOLD))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _shares(batch.column("counts"), slots), batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            tested = batch.column("tested").to_numpy(zero_copy_only=False).astype(bool)
            share = np.where(y == 1, class_weight[1], class_weight[0])
            z = x @ weights
            error = share * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
            loss = share * (np.logaddexp(0, z) - y * z)
            said, true = z > 0, y == 1
            sums[: slots + 1] += error[~tested] @ x[~tested]
            told = [true & said, true & ~said, ~true & said, ~true & ~said]
            sums[slots + 1 :] += [*((t & tested).sum() for t in told), loss[tested].sum(), share[tested].sum(), share[~tested].sum()]
        place = np.append(np.arange(slots + 1), -1 - np.arange(len(TOLD)))
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(sums)], ["place", "value"])

    sent = ready.mapInArrow(run, "place int, value double")
    return {r["place"]: r["value"] for r in sent.groupBy("place").agg(F.sum("value").alias("value")).collect()}


# what a pass tells besides the gradient
TOLD = ("tp", "fn", "fp", "tn", "loss", "test_weight", "train_weight")


def fit_epochs(rows: DataFrame, text: str, epochs: int = ITERATIONS, rate: float = 1.0, slots: int = 1 << 10, digits: int = 9) -> EpochFit:
    """A class-weighted logistic model by one full gradient step per epoch, scored on the test side after each.

    ``rows`` has ``label`` and ``split``; the train side's class counts weigh the classes, and a class
    without train rows is an error. Features are written once. An epoch is one scan that gives the
    gradient at the weights so far and their scores alike, so n epochs take n + 1 scans. Weights are
    rounded to ``digits``, so the order in which tasks' sums are added does not show.
    """
    balance = {r["label"]: r["weight"] for r in splits.class_weights(rows.where(F.col("split") == "train")).collect()}
    absent = [label for label, weight in balance.items() if weight is None]
    if absent:
        raise ValueError(f"no training rows of class {absent}")
    ready = md5_counts(rows, text, slots).select(F.col("label").cast("int").alias("label"), (F.col("split") == "test").alias("tested"), vector_to_array("counts").alias("counts"))
    ready = durable(ready)
    weights, kept, scored = np.zeros(slots + 1), [], []
    for epoch in range(epochs + 1):
        sums = _pass(ready, slots, weights, (balance[0], balance[1]))
        told = {name: sums[-1 - i] for i, name in enumerate(TOLD)}
        if epoch:
            loss = told["loss"] / told["test_weight"] if told["test_weight"] else None
            scored.append((epoch, *(int(told[c]) for c in TOLD[:4]), loss))
        gradient = np.array([sums[i] for i in range(slots + 1)]) / max(told["train_weight"], 1e-300)
        weights = np.round(weights - rate * gradient, digits)
        kept.append(weights)
    counts = rows.sparkSession.createDataFrame(scored, "epoch int, tp long, fn long, fp long, tn long, loss double")
    named = [F.col(c).alias(f"eval_{c}") for c in ("accuracy", "balanced_accuracy", "f1", "loss")]
    return EpochFit(report(counts).select("epoch", *named), kept[:epochs])


# ---------------------------------------------------------------- scores from logits


def argmax(scores: Column) -> Column:
    """Index of the highest score, the lowest index on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once per row, where a lambda would work it out per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def softmax(scores: Column) -> Column:
    """Shifted by the maximum, so that large scores do not overflow."""
    powers = _bound(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
    return _bound(powers, lambda each: _bound(_total(each), lambda total: F.transform(each, lambda p: p / total)))


def confidence(scores: Column) -> Column:
    return F.array_max(softmax(scores))


def log_loss(label: Column, scores: Column) -> Column:
    """-ln p[label], taken in logs."""
    said = F.element_at(scores, label.cast("int") + 1)
    return _bound(F.array_max(scores), lambda top: F.ln(_total(F.transform(scores, lambda s: F.exp(s - top)))) + top - said)


def weighted_log_loss(scored: DataFrame, *keys: str) -> DataFrame:
    """Class-weighted mean loss (weights divide out) and plain mean loss of (label, scores, weight)."""
    lossy = scored.withColumn("loss", log_loss(F.col("label"), F.col("scores")))
    return lossy.groupBy(*keys).agg(
        (F.sum(F.col("weight") * F.col("loss")) / F.sum("weight")).alias("weighted_log_loss"),
        F.avg("loss").alias("log_loss"),
        F.count("*").alias("n"),
    )


def eval_history(history: DataFrame) -> DataFrame:
    """Log rows that carry evaluation scores."""
    return history.where(F.col("eval_accuracy").isNotNull())


def best_checkpoint(history: DataFrame, by: str = "eval_balanced_accuracy") -> DataFrame:
    """The row with the highest score, the earliest on a tie."""
    rows = eval_history(history)
    first = F.struct((-F.col(by)).alias("worst"), F.col("epoch"))
    return rows.agg(F.min_by(F.struct(*rows.columns), first).alias("best")).select("best.*")
