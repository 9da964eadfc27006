"""The whole jobs, from a repository or a table of sources to saved tables and reports.

Each is a short composition of operators; results are DataFrames, nothing is printed.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.operators import chunking, classify, ireval, metrics, mutation, splits, vectors
from corpusops.schemas import CHUNK
from corpusops.session import durable
from corpusops.sources import repo_files
from corpusops.sources.examples import read_jsonl, with_correct, write_jsonl, write_metrics, write_predictions
from corpusops.sources.guards import require_columns, require_rows


def chunk_repository(spark: SparkSession, root: str, ignore_dirs=None) -> DataFrame:
    """Chunks of every Python file below a folder."""
    return audit_repository(spark, root, ignore_dirs)[0]


def audit_repository(spark: SparkSession, root: str, ignore_dirs=None) -> tuple[DataFrame, DataFrame]:
    """(chunks, rejects) from one scan and parse; rejects are (file, reason) of files without chunks."""
    files = durable(repo_files.decode_files(repo_files.scan_repo(spark, root, ignore_dirs)))
    parsed = durable(chunking.parse_units(files))
    unread = files.where(F.col("reject").isNotNull()).select(F.col("path").alias("file"), F.col("reject").alias("reason"))
    failed = parsed.where(F.col("error").isNotNull()).select("file", F.col("error").alias("reason"))
    return parsed.where(F.col("error").isNull()).select(*CHUNK.fieldNames()), unread.unionByName(failed)


def index_repository(spark: SparkSession, root: str, embedder, path: str, ignore_dirs=None) -> int:
    """Chunk, embed and save an index; returns the number of chunks. A fresh embedder is fitted first."""
    chunks = chunk_repository(spark, root, ignore_dirs)
    _fitted(embedder, chunks)
    return vectors.build_index(chunks, embedder, path)


def _fitted(embedder, chunks: DataFrame):
    if getattr(embedder, "weights", True) is None:
        embedder.fit(chunks.withColumn("text", vectors.embed_text()))
    return embedder


def search_index(index: DataFrame, embedder, queries: DataFrame, k: int = vectors.DEFAULT_K) -> DataFrame:
    """Hits of (query_id, query) with their display fields.

    Chunk ids repeat, so the search runs on the surrogate key.
    """
    keyed = index.withColumn("key", chunking.chunk_key())
    hits = vectors.search(keyed, embedder.embed(queries, "query"), k, id_col="key")
    return vectors.describe_hits(hits, keyed, key="key")


def compare_chunking(files: DataFrame, size: int = chunking.CHUNK_CHARS) -> DataFrame:
    """Per file of (path, text): fixed chunks, structural units, and units a fixed chunk cuts."""
    fixed = chunking.chunk_fixed(files.select("path", "text"), size=size).groupBy(F.col("path").alias("file"))
    cut = chunking.split_rate(chunking.chunk_code(files), "file", size=size)
    return fixed.agg(F.count("*").alias("fixed_chunks")).join(cut, "file", "left")


def evaluate_models(chunks: DataFrame, labelled: DataFrame, embedders: dict, k: int = ireval.RANK_DEPTH) -> tuple[DataFrame, DataFrame]:
    """(log, summary) of (query_id, query, expected_id) for each named embedder over the same chunks."""
    require_columns(labelled, "query_id", "query", "expected_id")
    kept = durable(require_rows(chunks, "no indexable chunks"))
    found = None
    for name, embedder in embedders.items():
        _fitted(embedder, kept)
        index = embedder.embed(kept.withColumn("content", vectors.embed_text()), "content")
        hits = search_index(index, embedder, labelled, k)
        named = hits.select("query_id", "rank", vectors.hit_id().alias("id"), F.lit(name).alias("model"))
        found = named if found is None else found.unionByName(named)
    log = ireval.retrieval_log(labelled, found, list(embedders))
    return log, ireval.retrieval_summary(log)


def generate_dataset(sources: DataFrame, path: str, seed: int = mutation.SEED) -> DataFrame:
    """Write shuffled examples of (source_id, code) as JSON lines; returns them as read back."""
    require_columns(sources, "source_id", "code")
    write_jsonl(mutation.shuffled(durable(mutation.examples(sources)), seed), path)
    return read_examples(sources.sparkSession, path)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Labelled examples for training; a record without one of their fields fails the job."""
    return read_jsonl(spark, path, required=("code", "label", "source_id", "mutation"))


def train_and_report(
    examples: DataFrame, model_path: str | None = None, metrics_path: str | None = None, candidates: dict[int, Pipeline] | None = None
) -> dict:
    """Holdout by source: balance, baseline, fitted model, scores and accuracy per kind of defect.

    Of several ``candidates`` the one is fitted that is best by balanced accuracy over folds of the
    train side; ``history`` then holds all their scores, and is None otherwise.
    """
    require_columns(examples, "code", "label", "source_id", "mutation")
    rows = durable(splits.group_holdout(examples, "source_id"))
    require_rows(rows, "no examples")
    if not splits.leaked_groups(rows, "source_id").isEmpty():
        raise AssertionError("a source lies on both sides of the split")
    train, test = (rows.where(F.col("split") == side) for side in ("train", "test"))
    history, estimator = None, None
    if candidates:
        folded = splits.group_kfold(train, "source_id")
        history = durable(classify.tuning_history(folded, "code", candidates))
        estimator = candidates[classify.best_checkpoint(history).first()["epoch"]]
    model = classify.fit(classify.featurize(train, "code"), estimator)
    scored = durable(classify.predict(model, classify.featurize(test, "code")).drop("counts"))
    report = metrics.report(metrics.confusion(scored))
    if model_path:
        model.write().overwrite().save(model_path)
    if metrics_path:
        write_metrics(report, metrics_path)
    return {
        "model": model,
        "history": history,
        "balance": splits.class_balance(rows, "split"),
        "baseline": splits.majority_baseline(test),
        "metrics": report,
        "by_mutation": metrics.by_category(scored, "mutation", worst_first=False),
        "predictions": scored,
    }


def cross_validate(examples: DataFrame, folds: int = splits.FOLDS, predictions_path: str | None = None) -> dict:
    """Out-of-fold predictions and their scores: per fold, mean and deviation, pooled, per kind."""
    require_columns(examples, "code", "label", "source_id", "mutation")
    folded = splits.group_kfold(examples, "source_id", folds)
    predicted = durable(with_correct(classify.out_of_fold(folded, "code", folds)))
    if predictions_path:
        write_predictions(predicted, predictions_path)
    counts = metrics.confusion(predicted, "fold")
    return {
        "predictions": predicted,
        "by_fold": metrics.report(counts),
        "summary": metrics.fold_summary(counts),
        "by_mutation": metrics.by_category(predicted, "mutation"),
    }


def score_saved_model(model_path: str, examples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row report, accuracy per category) of fresh (code, label, category) under a saved model."""
    scored = durable(classify.score_fresh(PipelineModel.load(model_path), examples))
    return scored, metrics.by_category(scored, "category")
