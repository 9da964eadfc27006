"""Joins that stay balanced when few keys hold most rows.

A task's fair share is the rows divided by the session's shuffle partitions. A key with more than a
``SPLIT``-th of that is heavy and is dealt in parts of about that size, so no key outweighs a task at
any scale. Fewer than ``SPLIT`` keys per shuffle partition can be heavy, which bounds the broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.session import durable

SPLIT = 16


def _parts(spark: SparkSession) -> int:
    return SPLIT * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _scatter(rows: DataFrame, ways: Column) -> Column:
    """A salt drawn from the row and its partition, so that a task run again deals its rows the same way."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.spark_partition_id()), ways).cast("int")


def _no_salt(key: str) -> Column:
    """Zero, but not as a literal: the planner would take a constant out of the join key."""
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("int")


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, ways) of heavy keys; tasks combine their counts before the shuffle."""
    spark = rows.sparkSession
    limit = max(1, rows.count() // _parts(spark))
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    return durable(counts.select(key, F.ceil(F.col("n") / limit).alias("_ways")))


def salted_left_join(rows: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    """``rows`` left join ``unique`` (one row per key): a heavy key's rows meet as many copies of its match as it has parts.

    Rows without a key match nothing and are spread.
    """
    heavy = F.broadcast(heavy_keys(rows, key))
    lone = F.when(F.col(key).isNull(), _scatter(rows, F.lit(_parts(rows.sparkSession))))
    salt = F.when(F.col("_ways").isNotNull(), _scatter(rows, F.col("_ways"))).otherwise(F.coalesce(lone, F.lit(0)))
    left = rows.join(heavy, key, "left").withColumn("_salt", salt).drop("_ways")
    copies = F.sequence(F.lit(0), (F.coalesce("_ways", F.lit(1)) - 1).cast("int"))
    right = unique.join(heavy, key, "left").withColumn("_salt", F.explode(copies)).drop("_ways")
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def with_group_value(rows: DataFrame, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Add ``lookup``'s value (lookup: key, size, value, one row per key) to rows.

    Values of heavy keys are broadcast; their rows then take a salt that matches nothing and
    spreads them through the join of the rest.
    """
    parts = _parts(rows.sparkSession)
    limit = max(1, (lookup.agg(F.sum("size")).first()[0] or 0) // parts)
    is_heavy = F.col("size") > limit
    heavy = lookup.where(is_heavy).select(key, F.col(value).alias("_heavy"))
    light = lookup.where(~is_heavy).select(key, _no_salt(key).alias("_salt"), F.col(value).alias("_light"))
    marked = rows.join(F.broadcast(heavy), key, "left")
    salt = F.when(F.col("_heavy").isNull(), _no_salt(key)).otherwise(1 + _scatter(rows, F.lit(parts)))
    joined = marked.withColumn("_salt", salt).join(light, [key, "_salt"], "left")
    return joined.select(*[F.col(c) for c in rows.columns], F.coalesce("_heavy", "_light").alias(value))
