"""Which intervals any set of cut points falls into: a binned join that stays an equi-join.

A point lies in one bin of fixed width. An interval looks at single points only in the bins its two
ends lie in; the bins between are covered by a few nodes of a binary hierarchy of bins, whose points
have been counted. So an interval over a million bins meets some forty rows, not a million.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 1024
# levels of the hierarchy: 2 ** LEVELS bins are covered by one node
LEVELS = 40


def _width(level: Column) -> Column:
    """Bins of a node."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def _nodes(low: Column, high: Column) -> Column:
    """The fewest (level, node) that make up the bins ``low`` to ``high`` - 1, two per level at most."""

    def at(level: Column) -> Column:
        width = _width(level)
        first, last = F.ceil(low / width).cast("bigint"), F.floor(high / width).cast("bigint")
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        node = lambda keep, number: F.when((first < last) & keep, F.struct(level.alias("level"), number.alias("node")))
        return F.array_compact(F.array(node(odd(first), first), node(odd(last), last - 1)))

    # nothing is covered above the level whose nodes are wider than the interval
    top = F.when(high > low, F.least(F.ceil(F.log2(F.greatest(high - low, F.lit(1)).cast("double"))).cast("int"), F.lit(LEVELS))).otherwise(0)
    return F.flatten(F.transform(F.sequence(F.lit(0), top), at))


def cuts_inside(units: DataFrame, cuts: DataFrame, *keys: str, start: str = "char_start", end: str = "char_end", at: str = "at", width: int = BIN) -> DataFrame:
    """``units`` with ``cuts_inside``: the number of cut points strictly between ``start`` and ``end``.

    Units and cuts meet where all ``keys`` are equal, so a null key has none; points and ends are whole
    numbers, repeated points count once each, repeated units alike. Both sides are reduced before they meet: points to counts per node, units to the
    few nodes that cover them, so neither long units nor keys with very many points make a hot task.
    """
    same = [F.col(f"`{k}`") for k in keys]
    # places that count are low to high - 1
    low, high = F.col(f"`{start}`").cast("bigint") + 1, F.col(f"`{end}`").cast("bigint")
    first, last = F.floor(low / width).cast("bigint"), F.floor((high - 1) / width).cast("bigint")
    span = F.struct(low.alias("low"), high.alias("high")).alias("_span")
    asked = units.where(high > low).select(*same, span, first.alias("_first"), last.alias("_last")).distinct()

    points = cuts.select(*same, F.col(f"`{at}`").cast("bigint").alias("_at"))
    binned = points.withColumn("_bin", F.floor(F.col("_at") / width).cast("bigint"))
    counted = binned.groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    above = F.explode(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda l: F.struct(l.alias("level"), F.floor(F.col("_bin") / _width(l)).cast("bigint").alias("node"))))
    nodes = counted.select(*keys, "_n", above.alias("_node")).groupBy(*keys, "_node").agg(F.sum("_n").alias("_n"))

    # the bins of the two ends, once if they are one
    ends = F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_bin")
    edge = asked.select(*keys, "_span", ends).join(binned.groupBy(*keys, "_bin", "_at").agg(F.count("*").alias("_n")), [*keys, "_bin"])
    near = edge.where((F.col("_at") >= F.col("_span.low")) & (F.col("_at") < F.col("_span.high"))).select(*keys, "_span", "_n")
    between = asked.where(F.col("_last") > F.col("_first") + 1).select(*keys, "_span", F.explode(_nodes(F.col("_first") + 1, F.col("_last"))).alias("_node"))
    far = between.join(nodes, [*keys, "_node"]).select(*keys, "_span", "_n")
    sums = near.union(far).groupBy(*keys, "_span").agg(F.sum("_n").alias("_n"))
    joined = units.withColumn("_span", span).join(sums, [*keys, "_span"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in units.columns], F.coalesce("_n", F.lit(0)).cast("bigint").alias("cuts_inside"))


def interval_split_rate(counted: DataFrame, *keys: str) -> DataFrame:
    """How many units any boundaries cut, and into how many pieces at most."""
    cut = F.col("cuts_inside") > 0
    return counted.groupBy(*keys).agg(
        F.count("*").alias("units"),
        F.count_if(cut).alias("cut_units"),
        (F.max("cuts_inside") + 1).alias("most_pieces"),
        F.avg(cut.cast("double")).alias("cut_rate"),
    )
