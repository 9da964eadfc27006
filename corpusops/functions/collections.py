"""Numeric, string and array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def divide(a: Column, b: Column) -> Column:
    """Fails on a zero divisor, whatever the session's ANSI setting."""
    failed = F.raise_error(F.lit("division by zero")).cast("double")
    return F.when(b == 0, failed).otherwise(F.try_divide(a.cast("double"), b.cast("double")))


def safe_divide(a: Column, b: Column, default: float = 0) -> Column:
    """``default`` for a zero divisor only; a null input stays null."""
    return F.when(b == 0, F.lit(default).cast("double")).otherwise(F.try_divide(a.cast("double"), b.cast("double")))


def clamp(value: Column, low: Column, high: Column) -> Column:
    bounded = F.greatest(low, F.least(value, high))
    return F.when(value.isNotNull() & low.isNotNull() & high.isNotNull(), bounded)


def average_or_zero(value: Column) -> Column:
    """Aggregate: the mean, or 0 over no values."""
    return F.coalesce(F.avg(value), F.lit(0.0))


def summary_stats(value: Column) -> list[Column]:
    """Aggregates: count, sum, mean, min, max, population variance and deviation."""
    return [
        F.count(value).alias("count"),
        F.sum(value).alias("sum"),
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.var_pop(value).alias("variance"),
        F.stddev_pop(value).alias("std_dev"),
    ]


def summarize(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """``summary_stats`` per key; a group, or a whole table, without values fails the job."""
    counted = df.groupBy(*keys).agg(*summary_stats(F.col(value)))
    empty = F.raise_error(F.lit("no values to summarize")).cast("bigint")
    return counted.withColumn("count", F.when(F.col("count") == 0, empty).otherwise(F.col("count")))


def is_palindrome(text: Column) -> Column:
    """Ignores case and the space character, nothing else."""
    cleaned = F.replace(F.lower(text), F.lit(" "), F.lit(""))
    return cleaned == F.reverse(cleaned)


def collapse_whitespace(text: Column) -> Column:
    """Single spaces between words, none around them."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def deduplicate(items: Column) -> Column:
    """First occurrences, in order."""
    return F.array_distinct(items)


def duplicates(items: Column) -> Column:
    """Values present more than once, each once, ascending, a repeated null first.

    Sorting puts equal values side by side, so one pass over neighbours finds them.
    """
    ordered = F.sort_array(items)
    later = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered) - 1, F.lit(0)))
    earlier = F.slice(ordered, F.lit(1), F.size(later))
    pairs = F.zip_with(earlier, later, lambda a, b: F.struct(a.alias("value"), a.eqNullSafe(b).alias("twice")))
    return F.array_distinct(F.transform(F.filter(pairs, lambda p: p["twice"]), lambda p: p["value"]))


def chunk_array(items: Column, size: int) -> Column:
    """Runs of at most ``size`` elements; an empty array has none."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(size))
    runs = F.transform(starts, lambda at: F.slice(items, at, F.lit(size)))
    return F.filter(runs, lambda run: F.size(run) > 0)


def flatten(nested: Column) -> Column:
    return F.flatten(nested)
