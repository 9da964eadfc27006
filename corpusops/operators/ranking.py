"""Exact ranks over hash keys without sorting a table, or one large group, in a single task.

Keys are md5 hex digests, so their first digits deal rows evenly over buckets that sort in key
order. A rank is the place within the bucket plus the rows in the buckets before it; the bucket
counts are at most ``16 ** digits`` rows per group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

PREFIX_DIGITS = 3
BUCKET_ROWS = 1 << 17


def prefix_digits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Digits that deal this many rows into buckets of at most ``bucket_rows`` or so, three at least."""
    return max(PREFIX_DIGITS, math.ceil(math.log(max(1.0, rows / bucket_rows), 16)))


def _offsets(df: DataFrame, by: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*by, "bucket").agg(F.count("*").alias("held"))
    before = W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0)))


def hash_rank(df: DataFrame, key: str, by: Sequence[str] = (), out: str = "rank", digits: int | None = None) -> DataFrame:
    """1-based rank of each row by ``key`` (unique md5 hex) within ``by``.

    ``df`` is read three times, for its count, the counts per bucket and the rows: pass a table or
    a ``durable`` frame. The number of buckets grows with the rows.
    """
    digits = digits or prefix_digits(df.count())
    dealt = df.withColumn("bucket", F.substring(key, 1, digits))
    offsets = _offsets(dealt, by).select(*by, "bucket", "offset")
    if not by:
        # at most 16 ** digits rows
        offsets = F.broadcast(offsets)
    place = F.row_number().over(W.partitionBy(*by, "bucket").orderBy(key))
    ranked = dealt.withColumn("place", place).join(offsets, [*by, "bucket"], "left")
    return ranked.withColumn(out, F.col("place") + F.col("offset")).select(*df.columns, out)


def key_at_fraction(keys: DataFrame, key: str, fraction: float, digits: int = PREFIX_DIGITS) -> DataFrame:
    """One row: the ``ceil(fraction * n)``-th smallest of n distinct md5 keys.

    A row belongs to the leading fraction when its key is no greater, which needs no join with
    the keys. Only the bucket the fraction ends in is sorted.
    """
    dealt = keys.withColumn("bucket", F.substring(key, 1, digits))
    offsets = _offsets(dealt, ())
    total = W.partitionBy()
    wanted = F.ceil(F.lit(fraction) * F.sum("held").over(total))
    last = (
        offsets.withColumn("wanted", wanted)
        .where((F.col("offset") < F.col("wanted")) & (F.col("wanted") <= F.col("offset") + F.col("held")))
        .select("bucket", (F.col("wanted") - F.col("offset")).alias("nth"))
    )
    inside = dealt.join(F.broadcast(last), "bucket")
    placed = inside.withColumn("place", F.row_number().over(W.partitionBy("bucket").orderBy(key)))
    return placed.where(F.col("place") == F.col("nth")).select(F.col(key).alias("last_key"))
