"""Connected components by alternating large-star and small-star steps, each a grouped minimum and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusops.session import durable


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40)), F.sum(F.xxhash64("v", "u") % (1 << 40))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links between longs to (u, v) with v the least node of u's component, for each u that is not the least.

    Every step keeps the components and brings nodes nearer to their least node; the rounds grow
    with the logarithm of the diameter. Each round's links are written to the shared folder, so lost
    executors cost no more than a round.
    """
    now = durable(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select("v", "u"))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") != F.col("u")).join(nearest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = durable(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where(F.col("u") != F.col("v")).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now
