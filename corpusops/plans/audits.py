"""Queries that look behind a split, an index, a training run and a chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.functions import text
from corpusops.operators import cells, chunking, classify, intervals, metrics, similarity, splits
from corpusops.plans import evaluation
from corpusops.plans.corpus import _LINES
from corpusops.plans.dataset import EXAMPLES_CTE
from corpusops.plans.evaluation import SCORES, _CONFUSION, _DOCS, _holdout_cte, _kfold_cte, _rounded, _scored_cte
from corpusops.plans.inputs import PARTS_CTE, PREDS_CTE, SEARCH_CTE, class_queries, documents, knn_cte, preds, table, vectors
from corpusops.plans.retrieval import DEPTH, _shown
from corpusops.session import scratch_path
from corpusops.sources import guards

SLOTS = 64
EPOCHS = 6
RATE = 20.0
# pieces between blanks that make one chunk
PIECES = 40
GUARDED = {"documents": "doc_id", "embeddings": "vec_id", "labels": "doc_id", "part": "p_partkey"}


def _near(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    return similarity.leaked_near(splits.group_holdout(docs, "source"), "doc_id", "text")


def split_leakage_near(spark, sf_dir):
    """Test documents of a split by source, and whether the train side has nearly the same text."""
    return _near(spark, sf_dir)


def split_leakage_near_rate(spark, sf_dir):
    return similarity.near_leakage(_near(spark, sf_dir))


def knn_topk_cells(spark, sf_dir):
    """The same hits as ``knn_topk``, from an index in cells."""
    path = cells.save_cells(vectors(spark, sf_dir).select("id", "embedding"), scratch_path(spark, "cells"))
    return _shown(cells.search_cells(*cells.load_cells(spark, path), class_queries(spark, sf_dir), DEPTH))


def _epochs(spark, sf_dir):
    rows = splits.group_holdout(preds(spark, sf_dir, "text").drop("predicted"), "source")
    return classify.fit_epochs(rows, "text", EPOCHS, RATE, SLOTS).history


def epoch_history(spark, sf_dir):
    """Scores of the held-out sources after each epoch of a fit on the others."""
    history = _epochs(spark, sf_dir)
    return _rounded(history, *history.columns[1:])


def best_epoch(spark, sf_dir):
    history = _epochs(spark, sf_dir)
    return _rounded(classify.best_checkpoint(history), *history.columns[1:])


def word_cuts(docs):
    """(doc_id, at): where chunks of ``PIECES`` blank-separated pieces begin, in characters; their lengths differ."""
    # only one length per chunk goes to Python; \G keeps the search linear where blanks are few
    runs = F.regexp_extract_all("text", F.lit(rf"\G(?:[^ ]*+ ){{{PIECES}}}"), F.lit(0))
    ends_in_blank = F.transform(runs, lambda run: F.length(run).cast("bigint") - 1)
    starts = chunking._starts(F.concat(ends_in_blank, F.array(F.lit(0).cast("bigint"))))
    each = docs.select("doc_id", F.posexplode(starts).alias("nth", "at"))
    return each.where(F.col("nth") > 0).select("doc_id", "at")


def interval_split_rate(spark, sf_dir):
    """Document lines that chunks of forty words would cut, per source."""
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    units = chunking.chunk_lines(docs).select("doc_id", "source", "char_start", "char_end")
    counted = intervals.cuts_inside(units, word_cuts(docs), "doc_id")
    return _rounded(intervals.interval_split_rate(counted, "source"), "cut_rate")


def cv_fold_grouping(spark, sf_dir):
    """Scores per fold and pooled over all folds, from one pass over the predictions."""
    folded = splits.group_kfold(preds(spark, sf_dir), "source")
    return _rounded(metrics.fold_and_pooled(folded).select("scope", "fold", "n", *SCORES), *SCORES)


def display_figures(spark, sf_dir):
    """Each language's share of the documents as text, and how far it lies from an equal share."""
    held = documents(spark, sf_dir, "lang").groupBy("lang").agg(F.count("*").alias("n"))
    total, langs = held.agg(F.sum("n").cast("double")).scalar(), held.agg(F.count("*")).scalar()
    share = held.withColumn("share", F.col("n") / total)
    return share.select("lang", text.percent(F.col("share")).alias("percent"), text.decimals(F.col("share") - 1 / langs, signed=True).alias("lift"))


def guarded_tables(spark, sf_dir):
    """What the checks at job boundaries say of each table: whether it has an id column, and rows for a filter."""
    said = []
    for name, column in GUARDED.items():
        held = table(spark, sf_dir, name)
        for guard, check in (
            ("column", lambda: guards.require_columns(held, column)),
            ("absent column", lambda: guards.require_columns(held.select(column), "nowhere")),
            ("rows", lambda: guards.require_rows(held.where(F.col(column) >= 0), "no rows")),
            ("absent rows", lambda: guards.require_rows(held.where(F.col(column) < 0), f"no rows of {name}")),
            ("absent path", lambda: guards.require_path(spark, f"{sf_dir}/{name}.none", f"no table {name}")),
        ):
            try:
                check()
                said.append((name, guard, "passed"))
            except (ValueError, FileNotFoundError) as problem:
                said.append((name, guard, str(problem)))
    return spark.createDataFrame(said, "held string, guard string, outcome string")


def cv_predictions_keys(spark, sf_dir):
    """What any out-of-fold model must give: every labelled document once, in the fold that did not train on it."""
    scored = evaluation.cv_predictions(spark, sf_dir)
    follows = (F.col("correct") == (F.col("label") == F.col("predicted"))).alias("follows")
    return scored.select("doc_id", "label", "fold", F.col("predicted").isin(0, 1).alias("is_class"), follows)


def classifier_fit_predict_keys(spark, sf_dir):
    """Every labelled document of the held-out sources once."""
    scored = evaluation.classifier_fit_predict(spark, sf_dir)
    in_range = F.col("confidence").between(0.5, 1.0).alias("in_range")
    return scored.select("doc_id", "label", F.col("predicted").isin(0, 1).alias("is_class"), in_range)


def code_classifier_totals(spark, sf_dir):
    """Examples per kind of defect on the held-out sources, whatever the model says of them."""
    return evaluation.code_classifier_report(spark, sf_dir).select("category", "total", F.col("correct").between(0, F.col("total")).alias("in_range"))


def fresh_code_keys(spark, sf_dir):
    """Every held-out source once, with the name it should have and a mark that follows from the name it got."""
    scored = evaluation.fresh_code_report(spark, sf_dir)
    follows = (F.col("mark") == F.when(F.col("predicted_name") == F.col("expected_name"), "PASS").otherwise("FAIL")).alias("follows")
    return scored.select("source_id", "expected_name", follows)


# ---------------------------------------------------------------- SQL

_GUARD_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS held, 'column' AS guard, 'passed' AS outcome
    UNION ALL SELECT '{name}', 'absent column', 'missing column(s) [''nowhere'']; found [''{column}'']'
    UNION ALL SELECT '{name}', 'rows', CASE WHEN count(*) FILTER ({column} >= 0) > 0 THEN 'passed' ELSE 'no rows' END FROM {name}
    UNION ALL SELECT '{name}', 'absent rows', CASE WHEN count(*) FILTER ({column} < 0) > 0 THEN 'passed' ELSE 'no rows of {name}' END FROM {name}
    UNION ALL SELECT '{name}', 'absent path', 'no table {name}'"""
    for name, column in GUARDED.items()
)

_NEAR_CTE = rf"""{_DOCS}, {_holdout_cte('docs', 'source')},
tokens AS (SELECT doc_id, split, regexp_extract_all(lower(coalesce(text, '')), '{similarity._WORD}') AS ws FROM held_out),
sets AS (SELECT doc_id, split, CASE WHEN len(ws) = 0 THEN [] ELSE
  list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - {similarity.SHINGLE_WORDS - 1}, 1) + 1),
    lambda i: array_to_string(ws[i:i + {similarity.SHINGLE_WORDS - 1}], ' ')))) END AS s FROM tokens),
named AS (SELECT *, min(doc_id) OVER (PARTITION BY s) AS class_id, count(*) FILTER (split = 'train') OVER (PARTITION BY s) AS same_rows FROM sets WHERE len(s) > 0),
kinds AS (SELECT DISTINCT class_id, split, s FROM named),
spread AS (SELECT class_id, split, len(s) AS n, unnest(s) AS w FROM kinds),
met AS (SELECT a.class_id, a.n, b.class_id AS other, b.n AS m, count(*) AS k FROM spread a JOIN spread b ON a.w = b.w AND a.split = 'test' AND b.split = 'train' GROUP BY ALL),
near AS (SELECT DISTINCT class_id FROM met WHERE {similarity.SHARED + similarity.OF} * k >= {similarity.SHARED} * (n + m)),
leaked AS (
  SELECT doc_id, class_id, same_rows, class_id IN (SELECT class_id FROM near) AS leaks FROM named WHERE split = 'test'
  UNION ALL SELECT doc_id, NULL, 0, false FROM sets WHERE split = 'test' AND len(s) = 0)"""


def _epochs_cte() -> str:
    steps = "w0 AS (SELECT slot, 0::DOUBLE AS w FROM range(%d) g(slot))" % (SLOTS + 1)
    scored = []
    for e in range(1, EPOCHS + 1):
        steps += f""",
z{e} AS (SELECT id, sum(w * v) AS z FROM x JOIN w{e - 1} USING (slot) GROUP BY id),
g{e} AS (SELECT slot, sum(weight * (1 / (1 + exp(-z)) - label) * v) / (SELECT sum(weight) FROM rows_ WHERE split = 'train') AS g
  FROM x JOIN z{e} USING (id) JOIN rows_ USING (id) WHERE split = 'train' GROUP BY slot),
w{e} AS (SELECT slot, round(w - {RATE} * coalesce(g, 0), 9) AS w FROM w{e - 1} LEFT JOIN g{e} USING (slot)),
t{e} AS (SELECT {e} AS epoch, label, weight, CAST(sum(w * v) > 0 AS INTEGER) AS predicted, sum(w * v) AS z FROM x JOIN w{e} USING (slot) JOIN rows_ USING (id) WHERE split = 'test' GROUP BY id, label, weight)"""
        scored.append(f"SELECT * FROM t{e}")
    return rf"""{PREDS_CTE}, {_holdout_cte('preds', 'source')},
balance AS (SELECT label, sum(count(*)) OVER () / (2 * count(*)) AS weight FROM held_out WHERE split = 'train' GROUP BY label),
rows_ AS (SELECT doc_id AS id, label, text, split, weight FROM held_out JOIN balance USING (label)),
tok AS (SELECT id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\x0b]')[1:128]) AS t FROM rows_),
tf AS (SELECT id, CAST(('0x' || substr(md5(t), 1, 6)) AS INTEGER) % {SLOTS} AS slot, count(*) AS tf FROM tok GROUP BY ALL),
x AS (SELECT id, slot, tf / sum(tf) OVER (PARTITION BY id) AS v FROM tf UNION ALL SELECT id, {SLOTS}, 1::DOUBLE FROM rows_),
{steps},
told AS ({' UNION ALL '.join(scored)}),
losses AS (SELECT epoch, sum(weight * (greatest(z, 0) + ln(1 + exp(-abs(z))) - label * z)) / sum(weight) AS loss FROM told GROUP BY epoch),
{_scored_cte(f'SELECT epoch, {_CONFUSION} FROM told GROUP BY epoch')},
history AS (SELECT CAST(epoch AS INTEGER) AS epoch, accuracy AS eval_accuracy, balanced_accuracy AS eval_balanced_accuracy, f1 AS eval_f1, loss AS eval_loss FROM c JOIN losses USING (epoch))"""


_EPOCH_COLUMNS = "epoch, round(eval_accuracy, 6) AS eval_accuracy, round(eval_balanced_accuracy, 6) AS eval_balanced_accuracy, round(eval_f1, 6) AS eval_f1, round(eval_loss, 6) AS eval_loss"

QUERIES = {
    "split_leakage_near": (split_leakage_near, f"WITH {_NEAR_CTE} SELECT * FROM leaked"),
    "split_leakage_near_rate": (
        split_leakage_near_rate,
        f"""WITH {_NEAR_CTE} SELECT count(*) AS test_rows, count(*) FILTER (leaks) AS leaked_rows,
            count(*) FILTER (leaks AND same_rows = 0) AS near_rows, round(avg(CAST(leaks AS INTEGER)), 6) AS leak_rate FROM leaked""",
    ),
    "knn_topk_cells": (knn_topk_cells, f"WITH {SEARCH_CTE}, {knn_cte('hits', DEPTH)} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM hits"),
    "epoch_history": (epoch_history, f"WITH {_epochs_cte()} SELECT {_EPOCH_COLUMNS} FROM history"),
    "best_epoch": (best_epoch, f"WITH {_epochs_cte()} SELECT {_EPOCH_COLUMNS} FROM history ORDER BY history.eval_balanced_accuracy DESC, epoch LIMIT 1"),
    "interval_split_rate": (
        interval_split_rate,
        f"""WITH {_LINES},
            pieces AS (SELECT doc_id, unnest(string_split(text, ' ')) AS p, generate_subscripts(string_split(text, ' '), 1) - 1 AS nth FROM documents),
            starts AS (SELECT doc_id, nth, CAST(coalesce(sum(length(p) + 1) OVER (PARTITION BY doc_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM pieces),
            cuts AS (SELECT doc_id, place FROM starts WHERE nth > 0 AND nth % {PIECES} = 0),
            counted AS (SELECT source, placed.doc_id, i, count(place) AS n FROM placed LEFT JOIN cuts ON cuts.doc_id = placed.doc_id AND place > s AND place < e GROUP BY ALL)
            SELECT source, count(*) AS units, count(*) FILTER (n > 0) AS cut_units, max(n) + 1 AS most_pieces, round(avg(CAST(n > 0 AS INTEGER)), 6) AS cut_rate
            FROM counted GROUP BY source""",
    ),
    "cv_predictions_keys": (
        cv_predictions_keys,
        f"WITH RECURSIVE {PREDS_CTE}, {_kfold_cte('preds', 'source')} SELECT doc_id, label, fold, true AS is_class, true AS follows FROM folded",
    ),
    "classifier_fit_predict_keys": (
        classifier_fit_predict_keys,
        f"WITH {PREDS_CTE}, {_holdout_cte('preds', 'source')} SELECT doc_id, label, true AS is_class, true AS in_range FROM held_out WHERE split = 'test'",
    ),
    "code_classifier_totals": (
        code_classifier_totals,
        f"""WITH {EXAMPLES_CTE}, {_holdout_cte('examples', 'source_id')}
            SELECT mutation AS category, count(*) AS total, true AS in_range FROM held_out WHERE split = 'test' GROUP BY mutation""",
    ),
    "fresh_code_keys": (
        fresh_code_keys,
        f"""WITH {PARTS_CTE}, files AS (SELECT k AS source_id FROM parts), {_holdout_cte('files', 'source_id')}
            SELECT source_id, 'clean' AS expected_name, true AS follows FROM held_out WHERE split = 'test'""",
    ),
    "display_figures": (
        display_figures,
        """WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
           s AS (SELECT lang, n / (sum(n) OVER ()) AS share, 1 / (count(*) OVER ()) AS equal FROM n)
           SELECT lang, format('{:.1f}%', round(share * 100, 1)) AS percent, format('{:+.3f}', round(share - equal, 3)) AS lift FROM s""",
    ),
    "guarded_tables": (guarded_tables, _GUARD_SQL),
    "cv_fold_grouping": (
        cv_fold_grouping,
        f"""WITH RECURSIVE {PREDS_CTE}, {_kfold_cte('preds', 'source')},
            {_scored_cte(f"SELECT CASE WHEN grouping(fold) = 1 THEN 'pooled' ELSE 'fold' END AS scope, fold, {_CONFUSION} FROM folded GROUP BY GROUPING SETS ((fold), ())")}
            SELECT scope, fold, n, {', '.join(f'round("{s}", 6) AS "{s}"' for s in SCORES)} FROM c""",
    ),
}
