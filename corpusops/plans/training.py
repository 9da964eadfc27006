"""Training and prediction that SQL can repeat: naive Bayes over md5 slots, weighted by class."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from corpusops.operators import classify, metrics, mutation, splits
from corpusops.plans.dataset import EXAMPLES_CTE
from corpusops.plans.evaluation import _CONFUSION, _holdout_cte, _kfold_cte, _scored_cte
from corpusops.plans.inputs import PREDS_CTE, preds, sources
from corpusops.session import durable, scratch_path
from corpusops.sources.examples import read_jsonl, write_predictions

SLOTS = 64
SMOOTHINGS = {1: 0.1, 2: 1.0, 3: 10.0}


def _held_out(rows, text, reload: bool = False):
    """Predictions of the test side by a model of the train side, saved and loaded in between if asked."""
    return _told(durable(classify.md5_counts(rows, text, SLOTS)), reload)


def _told(ready, reload: bool = False):
    model = classify.fit(ready.where(F.col("split") == "train"), classify.weighted_bayes())
    if reload:
        path = scratch_path(ready.sparkSession, "model")
        model.write().overwrite().save(path)
        model = PipelineModel.load(path)
    return classify.predict(model, ready.where(F.col("split") == "test"))


def bayes_holdout_predictions(spark, sf_dir, reload=False):
    rows = splits.group_holdout(preds(spark, sf_dir, "text").drop("predicted"), "source")
    scored = _held_out(rows, "text", reload)
    return scored.select("doc_id", "source", "label", "predicted", F.round("confidence", 6).alias("confidence"))


def bayes_reloaded_predictions(spark, sf_dir):
    """The same predictions by a model that was saved and loaded."""
    return bayes_holdout_predictions(spark, sf_dir, reload=True)


def bayes_cv_predictions(spark, sf_dir):
    """Out-of-fold predictions, through the predictions sink and back."""
    folded = splits.group_kfold(preds(spark, sf_dir, "text").drop("predicted"), "source")
    said = classify.out_of_fold(folded, "text", slots=SLOTS, estimator=classify.weighted_bayes(), features=classify.md5_counts)
    path = write_predictions(said.select("doc_id", "source", "label", "fold", "predicted"), scratch_path(spark, "predictions"))
    schema = "doc_id bigint, source string, label int, fold int, predicted int, correct boolean"
    return read_jsonl(spark, path, schema, required=("doc_id", "label", "predicted", "correct"))


def bayes_code_report(spark, sf_dir):
    """Accuracy per kind of defect on sources that training has not seen."""
    # the examples are made once, and leave their counts instead of their text
    ready = durable(classify.md5_counts(mutation.examples(sources(spark, sf_dir)), "code", SLOTS).drop("code"))
    report = metrics.by_category(_told(splits.group_holdout(ready, "source_id")), "mutation", worst_first=False)
    return report.withColumn("ratio", F.round("ratio", 6))


def _tuned(spark, sf_dir):
    folded = splits.group_kfold(preds(spark, sf_dir, "text").drop("predicted"), "source")
    candidates = {n: classify.weighted_bayes(smoothing) for n, smoothing in SMOOTHINGS.items()}
    return classify.tuning_history(folded, "text", candidates, slots=SLOTS, features=classify.md5_counts)


def tuning_history(spark, sf_dir):
    """Scores of each candidate over all folds."""
    history = _tuned(spark, sf_dir)
    return history.select("epoch", *[F.round(c, 6).alias(c) for c in history.columns[1:]])


def best_checkpoint_fit(spark, sf_dir):
    """The candidate that the folds find best."""
    return classify.best_checkpoint(_tuned(spark, sf_dir)).select("epoch", F.round("eval_balanced_accuracy", 6).alias("eval_balanced_accuracy"))


# ---------------------------------------------------------------- SQL


def _bayes_cte(rows: str, id_: str, text: str, part: str, tested: str = "true", smoothing: float = 1.0) -> str:
    """said(id, predicted, confidence): each tested part by a model of the other parts."""
    return rf"""r AS (SELECT {id_} AS id, label, {text} AS text, {part} AS part FROM {rows}),
p AS (SELECT DISTINCT part AS p FROM r WHERE {tested}),
tok AS (SELECT id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\x0b]')[1:128]) AS t FROM r),
tf AS (SELECT id, CAST(('0x' || substr(md5(t), 1, 6)) AS INTEGER) % {SLOTS} AS slot, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT p, label, count(*) AS n FROM r JOIN p ON part <> p GROUP BY p, label),
w AS (SELECT p, label, n, sum(n) OVER (PARTITION BY p) / (2 * n) AS weight FROM n),
prior AS (SELECT p, label, weight, ln(n * weight + {smoothing}::DOUBLE) - ln(sum(n * weight) OVER (PARTITION BY p) + 2 * {smoothing}::DOUBLE) AS pi FROM w),
s AS (SELECT p, label, slot, sum(tf) AS c FROM r JOIN p ON part <> p JOIN tf USING (id) GROUP BY ALL),
theta AS (
  SELECT p, label, slot, ln(coalesce(c, 0) * weight + {smoothing}::DOUBLE)
    - ln(sum(coalesce(c, 0) * weight) OVER (PARTITION BY p, label) + {SLOTS} * {smoothing}::DOUBLE) AS theta
  FROM prior CROSS JOIN range({SLOTS}) g(slot) LEFT JOIN s USING (p, label, slot)),
score AS (
  SELECT r.id, a.label AS c, a.pi + coalesce(sum(tf * theta), 0) AS score
  FROM r JOIN prior a ON r.part = a.p LEFT JOIN tf ON tf.id = r.id
  LEFT JOIN theta h ON h.p = a.p AND h.label = a.label AND h.slot = tf.slot GROUP BY r.id, a.label, a.pi),
sides AS (SELECT id, max(score) FILTER (c = 0) AS s0, max(score) FILTER (c = 1) AS s1 FROM score GROUP BY id),
said AS (SELECT id, CAST(s1 > s0 AS INTEGER) AS predicted, 1 / (1 + exp(-abs(s1 - s0))) AS confidence FROM sides)"""



def _tuning_cte() -> str:
    """history(epoch, eval_accuracy, eval_balanced_accuracy, eval_f1): one row per smoothing."""
    rows = " UNION ALL ".join(
        f"""SELECT {n} AS epoch, * FROM (WITH RECURSIVE {PREDS_CTE}, {_kfold_cte('preds', 'source')},
            {_bayes_cte('folded', 'doc_id', 'text', 'fold', smoothing=smoothing)},
            g AS (SELECT label, s.predicted FROM folded JOIN said s ON id = doc_id), {_scored_cte(f'SELECT {_CONFUSION} FROM g')}
            SELECT accuracy AS eval_accuracy, balanced_accuracy AS eval_balanced_accuracy, f1 AS eval_f1 FROM c)"""
        for n, smoothing in SMOOTHINGS.items()
    )
    return f"history AS ({rows})"


_HELD_OUT_SQL = f"""WITH {PREDS_CTE}, {_holdout_cte('preds', 'source')}, {_bayes_cte('held_out', 'doc_id', 'text', 'split', "part = 'test'")}
            SELECT doc_id, source, label, s.predicted, round(confidence, 6) AS confidence FROM held_out JOIN said s ON id = doc_id"""

QUERIES = {
    "tuning_history": (tuning_history, f"WITH {_tuning_cte()} SELECT * FROM history"),
    "best_checkpoint_fit": (
        best_checkpoint_fit,
        f"WITH {_tuning_cte()} SELECT epoch, eval_balanced_accuracy FROM history ORDER BY eval_balanced_accuracy DESC, epoch LIMIT 1",
    ),
    "bayes_holdout_predictions": (bayes_holdout_predictions, _HELD_OUT_SQL),
    "bayes_reloaded_predictions": (bayes_reloaded_predictions, _HELD_OUT_SQL),
    "bayes_cv_predictions": (
        bayes_cv_predictions,
        f"""WITH RECURSIVE {PREDS_CTE}, {_kfold_cte('preds', 'source')}, {_bayes_cte('folded', 'doc_id', 'text', 'fold')}
            SELECT doc_id, source, label, fold, s.predicted, s.predicted = label AS correct FROM folded JOIN said s ON id = doc_id""",
    ),
    "bayes_code_report": (
        bayes_code_report,
        f"""WITH {EXAMPLES_CTE}, numbered AS (SELECT *, row_number() OVER (ORDER BY source_id, label, mutation, code) AS row_id FROM examples),
            {_holdout_cte('numbered', 'source_id')}, {_bayes_cte('held_out', 'row_id', 'code', 'split', "part = 'test'")},
            k AS (SELECT mutation AS category, count(*) FILTER (predicted = label) AS correct, count(*) AS total
                  FROM held_out JOIN said ON id = row_id GROUP BY mutation)
            SELECT category, correct, total, round(correct / total, 6) AS ratio,
                   CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS pos FROM k""",
    ),
}
