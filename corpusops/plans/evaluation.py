"""Splits, leakage audits, training, prediction and classification reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import classify, metrics, mutation, splits
from corpusops.plans.inputs import PREDS_CTE, documents, preds, raw_sources, sources, table, vectors
from corpusops.session import durable, scratch_path
from corpusops.sources.examples import read_jsonl, with_correct, write_metrics

EPOCHS = 15


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


# ---------------------------------------------------------------- splits


def _holdout(spark, sf_dir):
    return splits.group_holdout(preds(spark, sf_dir), "source")


def group_holdout_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return splits.group_holdout(docs, "source")


def group_kfold(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return splits.group_kfold(docs, "source")


def group_kfold_by_customer(spark, sf_dir):
    """Many groups of few sizes: order lines grouped by customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return splits.group_kfold(orders, "o_custkey")


def group_kfold_loads(spark, sf_dir):
    return splits.fold_loads(splits.group_kfold(preds(spark, sf_dir), "source"), "source")


def group_kfold_invariants(spark, sf_dir):
    return splits.fold_coverage(splits.group_kfold(preds(spark, sf_dir), "source"), "source")


def _two_splits(spark, sf_dir):
    """The group-aware split, and one drawn per document, which leaks."""
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    by_group = splits.group_holdout(docs, "source").withColumn("kind", F.lit("by_group"))
    by_row = splits.group_holdout(docs, "doc_id").withColumn("kind", F.lit("by_row"))
    return by_group.unionByName(by_row)


def split_leakage_groups(spark, sf_dir):
    return splits.leaked_groups(_two_splits(spark, sf_dir).drop("text"), "source", "kind")


def split_leakage_texts(spark, sf_dir):
    """Texts that a split by source still leaks, as copies carry other sources."""
    docs = documents(spark, sf_dir, "source", "text")
    return splits.leaked_texts(splits.group_holdout(docs, "source"), "text", "source")


def split_class_balance(spark, sf_dir):
    return _rounded(splits.class_balance(_holdout(spark, sf_dir), "split"), "buggy_ratio")


def majority_baseline(spark, sf_dir):
    return _rounded(splits.majority_baseline(_holdout(spark, sf_dir), "split"), "majority_baseline_accuracy")


def class_weights(spark, sf_dir):
    train = _holdout(spark, sf_dir).where(F.col("split") == "train")
    return _rounded(splits.class_weights(train), "weight")


# ---------------------------------------------------------------- train and predict


def tokenize_truncate(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    cut = docs.select("doc_id", classify.tokens(F.col("text")).alias("tokens"))
    return cut.select("doc_id", F.size("tokens").cast("bigint").alias("n"), F.array_join("tokens", " ").alias("tokens"))


def classifier_fit_predict(spark, sf_dir):
    """Fit on the train side, score the test side."""
    rows = classify.featurize(splits.group_holdout(preds(spark, sf_dir, "text").drop("predicted"), "source"), "text")
    model = classify.fit(rows.where(F.col("split") == "train"))
    scored = classify.predict(model, rows.where(F.col("split") == "test"))
    return scored.select("doc_id", "source", "label", "predicted", F.round("confidence", 6).alias("confidence"))


def cv_predictions(spark, sf_dir):
    folded = splits.group_kfold(preds(spark, sf_dir, "text").drop("predicted"), "source")
    predicted = with_correct(classify.out_of_fold(folded, "text"))
    return predicted.select("doc_id", "source", "label", "fold", "predicted", "correct")


def _code_model(spark, sf_dir):
    """Features of the examples of the code corpus, split by source, and a model of the train side."""
    # a fit reads its rows many times: they are written as features, without their text
    ready = durable(classify.featurize(mutation.examples(sources(spark, sf_dir)), "code").drop("code"))
    rows = splits.group_holdout(ready, "source_id")
    return rows, classify.fit(rows.where(F.col("split") == "train"))


def code_classifier_report(spark, sf_dir):
    """Accuracy per kind of defect on sources that training has not seen."""
    rows, model = _code_model(spark, sf_dir)
    scored = classify.predict(model, rows.where(F.col("split") == "test"))
    return _rounded(metrics.by_category(scored, "mutation", worst_first=False), "ratio")


def fresh_code_report(spark, sf_dir):
    """Unformatted sources that training has not seen, all clean, scored one by one."""
    _, model = _code_model(spark, sf_dir)
    raw = splits.group_holdout(raw_sources(spark, sf_dir), "source_id").where(F.col("split") == "test")
    fresh = raw.select("source_id", "code", F.lit(0).alias("label"), F.lit(mutation.CLEAN).alias("category"))
    scored = classify.score_fresh(model, fresh)
    return scored.select("source_id", "mark", "predicted_name", "expected_name", F.round("confidence", 4).alias("confidence"))


def _scored(spark, sf_dir):
    """Each vector component as the score of one class; a class weighs n / (classes * its rows)."""
    rows = vectors(spark, sf_dir).select("id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("scores"))
    return splits.with_class_weight(rows, splits.balanced_weights(rows))


def argmax_label(spark, sf_dir):
    return vectors(spark, sf_dir).select("id", classify.argmax(F.col("embedding")).cast("bigint").alias("predicted"))


def softmax_confidence(spark, sf_dir):
    scored = _scored(spark, sf_dir).withColumn("p", classify.softmax(F.col("scores")))
    return scored.select(
        "id",
        F.round(F.element_at("p", F.col("label") + 1), 6).alias("p_label"),
        F.round(F.aggregate("p", F.lit(0.0), lambda a, b: a + b), 6).alias("mass"),
        classify.argmax(F.col("scores")).alias("predicted"),
        F.round(F.array_max("p"), 6).alias("confidence"),
    )


def weighted_log_loss(spark, sf_dir):
    return _rounded(classify.weighted_log_loss(_scored(spark, sf_dir)), "weighted_log_loss", "log_loss")


def _history(spark, sf_dir):
    """A log as a trainer keeps it: per epoch a row of training loss and a row of scores.

    Epoch e calls texts above 200 * e characters good; counts per epoch come from one pass.
    """
    rows = preds(spark, sf_dir).drop("predicted")
    epoch = F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))).alias("epoch")
    guessed = rows.select("label", "n_chars", epoch).withColumn("predicted", (F.col("n_chars") > 200 * F.col("epoch")).cast("int"))
    scored = metrics.report(metrics.confusion(guessed, "epoch"))
    evals = scored.select(
        "epoch",
        F.lit(None).cast("double").alias("loss"),
        F.col("accuracy").alias("eval_accuracy"),
        F.col("balanced_accuracy").alias("eval_balanced_accuracy"),
        F.col("f1").alias("eval_f1"),
    )
    empty = F.lit(None).cast("double")
    losses = scored.select("epoch", (1 - F.col("accuracy")).alias("loss"), *[empty.alias(c) for c in evals.columns[2:]])
    return losses.unionByName(evals)


def eval_history(spark, sf_dir):
    kept = classify.eval_history(_history(spark, sf_dir)).drop("loss")
    return _rounded(kept, "eval_accuracy", "eval_balanced_accuracy", "eval_f1")


def best_checkpoint(spark, sf_dir):
    best = classify.best_checkpoint(_history(spark, sf_dir)).drop("loss")
    return _rounded(best, "eval_accuracy", "eval_balanced_accuracy", "eval_f1")


# ---------------------------------------------------------------- reports


def score_report(spark, sf_dir):
    return metrics.score_report(preds(spark, sf_dir)).select("doc_id", "lang", "mark", "predicted_name", "expected_name")


def confusion_counts(spark, sf_dir):
    return metrics.confusion(preds(spark, sf_dir), "lang")


SCORES = (
    "accuracy", "balanced_accuracy", "precision", "recall", "f1", "specificity", "majority_baseline_accuracy", "lift",
)


def metrics_report(spark, sf_dir):
    return _rounded(metrics.report(metrics.confusion(preds(spark, sf_dir))), *SCORES)


def metrics_roundtrip(spark, sf_dir):
    """The report as one JSON record of doubles, read back."""
    numbers = metrics.report(metrics.confusion(preds(spark, sf_dir))).select("n", *SCORES)
    path = write_metrics(numbers, scratch_path(spark, "metrics"))
    schema = ", ".join(f"{c} double" for c in numbers.columns)
    return _rounded(read_jsonl(spark, path, schema), *SCORES)


def cv_fold_metrics(spark, sf_dir):
    folded = splits.group_kfold(preds(spark, sf_dir), "source")
    return _rounded(metrics.report(metrics.confusion(folded, "fold")).select("fold", "n", *SCORES), *SCORES)


def cv_fold_summary(spark, sf_dir):
    folded = splits.group_kfold(preds(spark, sf_dir), "source")
    return _rounded(metrics.fold_summary(metrics.confusion(folded, "fold")), "mean", "std", "pooled")


def metrics_by_category(spark, sf_dir):
    return _rounded(metrics.by_category(preds(spark, sf_dir), "lang"), "ratio")


def metrics_by_category_name(spark, sf_dir):
    return _rounded(metrics.by_category(preds(spark, sf_dir), "source", worst_first=False), "ratio")


# ---------------------------------------------------------------- SQL


def _holdout_cte(rows: str, group: str, name: str = "held_out") -> str:
    return f"""{name}_k AS (SELECT g, row_number() OVER (ORDER BY md5(concat('42:', g))) AS rn FROM (SELECT DISTINCT {group} AS g FROM {rows})),
{name} AS (SELECT r.*, CASE WHEN rn <= ceil(0.2::DOUBLE * (SELECT count(*) FROM {name}_k)) THEN 'test' ELSE 'train' END AS split
  FROM {rows} r JOIN {name}_k ON g = r.{group})"""


def _kfold_cte(rows: str, group: str) -> str:
    """Greedy over groups, largest first: each to the lightest fold, the lower one on a tie."""
    return f"""sized AS (SELECT {group} AS g, count(*) AS size FROM {rows} GROUP BY {group}),
lined AS (SELECT g, size, row_number() OVER (ORDER BY size DESC, md5(concat('42:', g))) AS i FROM sized),
placed(i, fold, loads) AS (
  SELECT 0::BIGINT, NULL::INTEGER, [0, 0, 0, 0, 0]::BIGINT[]
  UNION ALL
  SELECT i, fold, list_transform(loads, lambda x, p: CASE WHEN p = fold + 1 THEN x + size ELSE x END)
  FROM (SELECT l.i, l.size, p.loads, CAST(list_position(p.loads, list_min(p.loads)) - 1 AS INTEGER) AS fold
        FROM placed p JOIN lined l ON l.i = p.i + 1)),
folded AS (SELECT r.*, fold FROM {rows} r JOIN lined ON g = r.{group} JOIN placed USING (i))"""


_CONFUSION = """count(*) FILTER (label = 1 AND predicted = 1) AS tp, count(*) FILTER (label = 1 AND predicted = 0) AS fn,
  count(*) FILTER (label = 0 AND predicted = 1) AS fp, count(*) FILTER (label = 0 AND predicted = 0) AS tn"""
_BALANCED = """list_avg(list_filter([tn / nullif(tn + fp, 0), tp / nullif(tp + fn, 0)], lambda r: r IS NOT NULL))"""


def _scored_cte(counts: str) -> str:
    """c: counts with all scores."""
    return f"""c0 AS ({counts}), c1 AS (
  SELECT *, tp + fn + fp + tn AS n, {_BALANCED} AS ba FROM c0),
c AS (SELECT *, round((tp + tn) / n, 6) AS accuracy, round(ba, 6) AS balanced_accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(tn / nullif(tn + fp, 0), 6) AS specificity,
  round(greatest(tp + fn, tn + fp) / n, 6) AS majority_baseline_accuracy, round(ba - 0.5, 6) AS lift FROM c1)"""


_SCORE_LIST = """accuracy, balanced_accuracy, "precision", recall, f1, specificity, majority_baseline_accuracy, lift"""
_HISTORY_CTE = f"""{PREDS_CTE}, {_scored_cte(f'''SELECT epoch, {_CONFUSION} FROM (
  SELECT CAST(epoch AS INTEGER) AS epoch, label, CAST(n_chars > 200 * epoch AS INTEGER) AS predicted
  FROM preds CROSS JOIN range(1, {EPOCHS + 1}) e(epoch)) GROUP BY epoch''')}"""
_EVALS = "epoch, accuracy AS eval_accuracy, balanced_accuracy AS eval_balanced_accuracy, f1 AS eval_f1"
_DOCS = "docs AS (SELECT doc_id, source, text FROM documents)"
_SCORES_CTE = """w AS (SELECT vec_id AS id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT label, (SELECT count(*) FROM w) / ((SELECT count(DISTINCT label) FROM w) * count(*)) AS weight FROM w GROUP BY label),
x AS (SELECT id, label, weight, e, list_transform(e, lambda v: exp(v - list_max(e))) AS a FROM w JOIN n USING (label)),
p AS (SELECT id, label, weight, e, list_transform(a, lambda v: v / list_sum(a)) AS p FROM x)"""

QUERIES = {
    "group_holdout_split": (
        group_holdout_split,
        f"WITH {_DOCS}, {_holdout_cte('docs', 'source')} SELECT doc_id, source, split FROM held_out",
    ),
    "group_kfold": (
        group_kfold,
        f"WITH RECURSIVE {_DOCS}, {_kfold_cte('docs', 'source')} SELECT doc_id, source, fold FROM folded",
    ),
    "group_kfold_by_customer": (
        group_kfold_by_customer,
        f"WITH RECURSIVE {_kfold_cte('orders', 'o_custkey')} SELECT o_orderkey, o_custkey, fold FROM folded",
    ),
    "group_kfold_loads": (
        group_kfold_loads,
        f"""WITH RECURSIVE {PREDS_CTE}, {_kfold_cte('preds', 'source')}
            SELECT fold, count(*) AS rows, count(DISTINCT source) AS groups FROM folded GROUP BY fold""",
    ),
    "group_kfold_invariants": (
        group_kfold_invariants,
        f"""WITH {PREDS_CTE} SELECT count(*) AS rows, count(*) AS covered_rows, count(DISTINCT source) AS groups,
            CAST(0 AS BIGINT) AS groups_in_many_folds, true AS all_covered FROM preds""",
    ),
    "split_leakage_groups": (
        split_leakage_groups,
        f"""WITH {_DOCS}, {_holdout_cte('docs', 'source', 'a')}, {_holdout_cte('docs', 'doc_id', 'b')},
            u AS (SELECT 'by_group' AS kind, source, split FROM a UNION ALL SELECT 'by_row', source, split FROM b)
            SELECT kind, source, count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows
            FROM u GROUP BY kind, source HAVING train_rows > 0 AND test_rows > 0""",
    ),
    "split_leakage_texts": (
        split_leakage_texts,
        rf"""WITH {_DOCS}, {_holdout_cte('docs', 'source')},
            k AS (SELECT md5(trim(regexp_replace(lower(text), '[\s\x0b]+', ' ', 'g'))) AS text_key, source, split FROM held_out)
            SELECT text_key, count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows,
                   count(DISTINCT source) AS groups FROM k GROUP BY text_key HAVING train_rows > 0 AND test_rows > 0""",
    ),
    "split_class_balance": (
        split_class_balance,
        f"""WITH {PREDS_CTE}, {_holdout_cte('preds', 'source')} SELECT split, count(*) FILTER (label = 0) AS clean,
            count(*) FILTER (label = 1) AS buggy, round(avg(label), 6) AS buggy_ratio FROM held_out GROUP BY split""",
    ),
    "majority_baseline": (
        majority_baseline,
        f"""WITH {PREDS_CTE}, {_holdout_cte('preds', 'source')},
            c AS (SELECT split, label, count(*) AS n, sum(count(*)) OVER (PARTITION BY split) AS total,
                         row_number() OVER (PARTITION BY split ORDER BY count(*) DESC, label) AS rn FROM held_out GROUP BY split, label)
            SELECT split, CAST(label AS INTEGER) AS majority_class, round(n / total, 6) AS majority_baseline_accuracy FROM c WHERE rn = 1""",
    ),
    "class_weights": (
        class_weights,
        f"""WITH {PREDS_CTE}, {_holdout_cte('preds', 'source')}, t AS (SELECT * FROM held_out WHERE split = 'train')
            SELECT CAST(label AS INTEGER) AS label, count(*) AS "count", round((SELECT count(*) FROM t) / (2 * count(*)), 6) AS weight
            FROM t GROUP BY label""",
    ),
    "tokenize_truncate": (
        tokenize_truncate,
        r"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x0b]')[1:128] AS tokens FROM documents)
            SELECT doc_id, len(tokens) AS n, array_to_string(tokens, ' ') AS tokens FROM t""",
    ),
    "classifier_fit_predict": (classifier_fit_predict, None),
    "cv_predictions": (cv_predictions, None),
    "code_classifier_report": (code_classifier_report, None),
    "fresh_code_report": (fresh_code_report, None),
    "argmax_label": (
        argmax_label,
        "SELECT vec_id AS id, list_position(embedding, list_max(embedding)) - 1 AS predicted FROM embeddings",
    ),
    "softmax_confidence": (
        softmax_confidence,
        f"""WITH {_SCORES_CTE} SELECT id, round(p[label + 1], 6) AS p_label, round(list_sum(p), 6) AS mass,
            list_position(e, list_max(e)) - 1 AS predicted, round(list_max(p), 6) AS confidence FROM p""",
    ),
    "weighted_log_loss": (
        weighted_log_loss,
        f"""WITH {_SCORES_CTE}, l AS (SELECT weight, -ln(p[label + 1]) AS loss FROM p)
            SELECT round(sum(weight * loss) / sum(weight), 6) AS weighted_log_loss, round(avg(loss), 6) AS log_loss, count(*) AS n FROM l""",
    ),
    "eval_history": (eval_history, f"WITH {_HISTORY_CTE} SELECT {_EVALS} FROM c"),
    "best_checkpoint": (
        best_checkpoint,
        f"WITH {_HISTORY_CTE} SELECT {_EVALS} FROM c ORDER BY ba DESC, epoch LIMIT 1",
    ),
    "score_report": (
        score_report,
        f"""WITH {PREDS_CTE} SELECT doc_id, lang, CASE WHEN label = predicted THEN 'PASS' ELSE 'FAIL' END AS mark,
            CASE predicted WHEN 1 THEN 'buggy' ELSE 'clean' END AS predicted_name,
            CASE label WHEN 1 THEN 'buggy' ELSE 'clean' END AS expected_name FROM preds""",
    ),
    "confusion_counts": (confusion_counts, f"WITH {PREDS_CTE} SELECT lang, {_CONFUSION} FROM preds GROUP BY lang"),
    "metrics_report": (
        metrics_report,
        f"""WITH {PREDS_CTE}, {_scored_cte(f'SELECT {_CONFUSION} FROM preds')}
            SELECT tp, fn, fp, tn, n, {_SCORE_LIST}, tp + fp = 0 OR fn + tn = 0 AS constant_predictor,
                   ba - 0.5 < 0.05 AS barely_above_floor FROM c""",
    ),
    "metrics_roundtrip": (
        metrics_roundtrip,
        f"WITH {PREDS_CTE}, {_scored_cte(f'SELECT {_CONFUSION} FROM preds')} SELECT n::DOUBLE AS n, {_SCORE_LIST} FROM c",
    ),
    "cv_fold_metrics": (
        cv_fold_metrics,
        f"""WITH RECURSIVE {PREDS_CTE}, {_kfold_cte('preds', 'source')}, {_scored_cte(f'SELECT fold, {_CONFUSION} FROM folded GROUP BY fold')}
            SELECT fold, n, {_SCORE_LIST} FROM c""",
    ),
    "cv_fold_summary": (
        cv_fold_summary,
        f"""WITH RECURSIVE {PREDS_CTE}, {_kfold_cte('preds', 'source')},
            f AS (SELECT fold, {_CONFUSION} FROM folded GROUP BY fold), s AS (SELECT {_BALANCED} AS ba FROM f),
            t AS (SELECT {_CONFUSION} FROM folded)
            SELECT count(*) AS folds, round(avg(ba), 6) AS mean, round(stddev_pop(ba), 6) AS std,
                   (SELECT round({_BALANCED}, 6) FROM t) AS pooled FROM s""",
    ),
    "metrics_by_category": (
        metrics_by_category,
        f"""WITH {PREDS_CTE}, k AS (SELECT lang AS category, count(*) FILTER (label = predicted) AS correct, count(*) AS total FROM preds GROUP BY lang)
            SELECT category, correct, total, round(correct / total, 6) AS ratio,
                   CAST(row_number() OVER (ORDER BY correct / total, category) AS INTEGER) AS pos FROM k""",
    ),
    "metrics_by_category_name": (
        metrics_by_category_name,
        f"""WITH {PREDS_CTE}, k AS (SELECT source AS category, count(*) FILTER (label = predicted) AS correct, count(*) AS total FROM preds GROUP BY source)
            SELECT category, correct, total, round(correct / total, 6) AS ratio,
                   CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS pos FROM k""",
    ),
}
