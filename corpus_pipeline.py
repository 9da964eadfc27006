"""From raw documents to packed training sequences, in five stages that each rewrite the corpus.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpusops
from corpusops.llm import line_dedup, queries, simhash_trie, sparse_suffix, weak_labels
from corpusops.session import durable, shuffles_go

# the functions travel with the tasks, so executors need no copy of the package
cloudpickle.register_pickle_by_value(corpusops)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely junk than clean go."""
    return weak_labels.kept(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them."""
    return _counted(line_dedup.deduplicated(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 0.8 of their five-word shingles the one with the smallest id stays."""
    return simhash_trie.deduplicated(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id has too are cut out."""
    return _counted(sparse_suffix.deduplicated(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token sequences of at most 1024 ids."""
    return queries.packed(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("packing", packing),
]

# models and tokenizers are not SQL; the stages are tested one by one against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        with shuffles_go(spark):
            docs = durable(kept)
    return STAGES[-1][1](spark, docs, sf_dir)
