"""Retrieval quality: hit@k, top-1, rank, reciprocal rank and their means, per model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Depth of the hit test, and of the ranking behind the reciprocal rank.
HIT_DEPTH = 3
RANK_DEPTH = 5


def retrieval_log(
    labelled: DataFrame, hits: DataFrame, models: list[str] | None = None, hit_depth: int = HIT_DEPTH, depth: int = RANK_DEPTH
) -> DataFrame:
    """One row per query (and model): ids in rank order, hit, top-1 hit, rank, reciprocal rank.

    ``labelled`` is (query_id, expected_id), ``hits`` (query_id, rank, id[, model]). A query
    without hits keeps its row. Where an id is returned twice, its first place counts.
    """
    keys = ["query_id"]
    asked = labelled.select("query_id", "expected_id")
    if models is not None:
        asked = asked.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
        keys.append("model")
    found = hits.where(F.col("rank") <= depth).select(*keys, "rank", "id")
    is_match = F.col("id") == F.col("expected_id")
    ordered = F.sort_array(F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("rank", "id"))))
    per_query = asked.join(found, keys, "left").groupBy(*keys, "expected_id").agg(
        F.transform(ordered, lambda h: h["id"]).alias("retrieved"),
        F.coalesce(F.max(is_match & (F.col("rank") <= hit_depth)), F.lit(False)).alias("hit"),
        F.coalesce(F.max(is_match & (F.col("rank") == 1)), F.lit(False)).alias("top1_hit"),
        F.min(F.when(is_match, F.col("rank"))).alias("rank"),
    )
    return per_query.withColumn("reciprocal_rank", F.coalesce(1 / F.col("rank").cast("double"), F.lit(0.0)))


def retrieval_summary(log: DataFrame) -> DataFrame:
    """Accuracy at the hit depth, top-1 accuracy and mean reciprocal rank, per model where named."""
    keys = ["model"] if "model" in log.columns else []
    return log.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.count_if("hit").alias("hits"),
        F.avg(F.col("hit").cast("double")).alias("accuracy"),
        F.count_if("top1_hit").alias("top1_hits"),
        F.avg(F.col("top1_hit").cast("double")).alias("top1_accuracy"),
        F.avg("reciprocal_rank").alias("mrr"),
    )


def retrieval_failures(log: DataFrame, on: str = "hit") -> DataFrame:
    """Queries that missed, with what came back instead and the top result."""
    return log.where(~F.col(on)).withColumn("top_result", F.try_element_at("retrieved", F.lit(1)))
