"""Leak-free holdouts and folds by group, leakage audits, class balance and weights."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.operators.ranking import hash_rank, key_at_fraction
from corpusops.operators.skew import with_group_value
from corpusops.session import durable

# Share of groups held out, number of folds, seed.
TEST_SHARE = 0.2
FOLDS = 5
SEED = 42


def group_key(group: str | Column, seed: int = SEED) -> Column:
    """Place of a group in the draw; a null group, which no join would find again, fails the job."""
    column = (F.col(group) if isinstance(group, str) else group).cast("string")
    known = F.coalesce(column, F.raise_error(F.lit("a group is null")).cast("string"))
    return F.md5(F.concat(F.lit(f"{seed}:"), known))


def group_holdout(rows: DataFrame, group: str, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Adds ``split``: ``ceil(share * groups)`` groups, drawn by hash, are the test side.

    The draw reduces to one threshold key, so rows are labelled where they are: no join, no
    shuffle of rows, and nothing to balance when one group holds most of them.
    """
    keys = rows.select(F.col(group)).distinct().select(group_key(group, seed).alias("key"))
    last = key_at_fraction(keys, "key", share).scalar()
    return rows.withColumn("split", F.when(group_key(group, seed) <= last, "test").otherwise("train"))


# ---------------------------------------------------------------- balanced folds


def _turns(loads: list[int], size: int, count: int) -> list[tuple[int, list[int]]]:
    """Which fold takes the r-th of ``count`` groups of one size, and the loads after them.

    Giving each group to the lightest fold merges the progressions load, load + size, ... of the
    folds. Seen in units of ``size``, a fold takes part from the level of its load on, and within
    a level folds go by remainder, then number. So the order is a short list of stretches
    (first rank, folds in rotation), whatever the count. ``loads`` is advanced in place.
    """
    level = [load // size for load in loads]
    order = sorted(range(len(loads)), key=lambda f: (loads[f] % size, f))
    starts = sorted(set(level))
    stretches, given = [], 0
    for i, at in enumerate(starts):
        taking = [f for f in order if level[f] <= at]
        room = count - given
        if i + 1 < len(starts):
            room = min(room, (starts[i + 1] - at) * len(taking))
        if room <= 0:
            break
        stretches.append((given + 1, taking))
        for place, f in enumerate(taking):
            loads[f] += size * (room // len(taking) + (place < room % len(taking)))
        given += room
    return stretches


def fold_plan(histogram: Iterable[tuple[int, int]], folds: int = FOLDS) -> Iterator[tuple]:
    """(size, stretches) from (group size, groups of that size), largest size first."""
    loads = [0] * folds
    for size, count in sorted(histogram, reverse=True):
        yield size, _turns(loads, size, count)


def group_folds(rows: DataFrame, group: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """(group, size, key, fold): largest groups first, each to the fold with fewest rows so far.

    Equal sizes go by hash, equal loads to the lower fold. The driver sees only the histogram of
    sizes: d distinct sizes need d * (d + 1) / 2 rows, so it is short for any table.
    """
    sizes = durable(rows.groupBy(group).agg(F.count("*").alias("size")).withColumn("key", group_key(group, seed)))
    spark = rows.sparkSession
    histogram = [tuple(r) for r in sizes.groupBy("size").agg(F.count("*")).collect()]
    if sum(n for _, n in histogram) < folds:
        raise ValueError(f"fewer groups than the {folds} folds asked for")
    plan = spark.createDataFrame(
        list(fold_plan(histogram, folds)), "size bigint, turns array<struct<first: bigint, folds: array<int>>>"
    )
    # one row per distinct size, on the driver already: groups of one common size stay where they are
    ranked = hash_rank(sizes, "key", by=["size"], out="nth").join(F.broadcast(plan), "size")
    turn = F.element_at(F.filter("turns", lambda t: t["first"] <= F.col("nth")), -1)
    rotation = F.pmod(F.col("nth") - F.col("turn.first"), F.size("turn.folds")).cast("int")
    return ranked.withColumn("turn", turn).select(
        group, "size", "key", F.element_at(F.col("turn.folds"), rotation + 1).alias("fold")
    )


def group_kfold(rows: DataFrame, group: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Adds ``fold``. Rows of heavy groups meet a small broadcast table instead of the shuffle."""
    assigned = durable(group_folds(rows, group, folds, seed))
    return with_group_value(rows, assigned, group, "fold")


def fold_loads(folded: DataFrame, group: str) -> DataFrame:
    """Rows and groups per fold, from one row per group and fold."""
    per_group = folded.groupBy("fold", group).agg(F.count("*").alias("n"))
    return per_group.groupBy("fold").agg(F.sum("n").alias("rows"), F.count("*").alias("groups"))


def fold_coverage(folded: DataFrame, group: str) -> DataFrame:
    """Whether every row has a fold and every group exactly one."""
    per_group = folded.groupBy(group).agg(
        F.count("*").alias("n"), F.count("fold").alias("given"), F.min("fold").alias("low"), F.max("fold").alias("high")
    )
    return per_group.agg(
        F.sum("n").alias("rows"),
        F.sum("given").alias("covered_rows"),
        F.count("*").alias("groups"),
        F.count_if(F.col("low") < F.col("high")).alias("groups_in_many_folds"),
        (F.sum("n") == F.sum("given")).alias("all_covered"),
    )


# ---------------------------------------------------------------- leakage


def leaked_groups(rows: DataFrame, group: str, *keys: str) -> DataFrame:
    """Groups on both sides of a split, with their rows on each side; none in a leak-free split."""
    return _on_both_sides(_side_counts(rows, *keys, group))


def _side_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("split") == "train").alias("train_rows"), F.count_if(F.col("split") == "test").alias("test_rows")
    )


def _on_both_sides(counts: DataFrame) -> DataFrame:
    return counts.where((F.col("train_rows") > 0) & (F.col("test_rows") > 0))


def text_fingerprint(text: Column) -> Column:
    """Same value for texts that differ in case and spacing only."""
    return F.md5(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")))


def leaked_texts(rows: DataFrame, text: str, group: str) -> DataFrame:
    """Texts on both sides of a split, whatever their groups.

    Counted per (text, group) first, then per text: a text with very many copies is combined
    before each shuffle.
    """
    marked = rows.select(text_fingerprint(F.col(text)).alias("text_key"), group, "split")
    per_group = _side_counts(marked, "text_key", group)
    per_text = per_group.groupBy("text_key").agg(
        F.sum("train_rows").alias("train_rows"), F.sum("test_rows").alias("test_rows"), F.count("*").alias("groups")
    )
    return _on_both_sides(per_text)


# ---------------------------------------------------------------- balance


def class_balance(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("label") == 0).alias("clean"),
        F.count_if(F.col("label") == 1).alias("buggy"),
        F.avg(F.col("label").cast("double")).alias("buggy_ratio"),
    )


def majority_baseline(rows: DataFrame, *keys: str) -> DataFrame:
    """The more frequent class (a tie goes to 0) and the accuracy of always naming it."""
    counted = class_balance(rows, *keys)
    most = F.greatest("clean", "buggy")
    return counted.select(
        *keys,
        F.when(F.col("buggy") > F.col("clean"), 1).otherwise(0).alias("majority_class"),
        F.try_divide(most.cast("double"), F.col("clean") + F.col("buggy")).alias("majority_baseline_accuracy"),
    )


def class_weights(rows: DataFrame, *keys: str) -> DataFrame:
    """``n / (2 * n_c)`` per class, null where the class is absent."""
    counted = class_balance(rows, *keys)
    n = (F.col("clean") + F.col("buggy")).cast("double")
    each = F.array(
        F.struct(F.lit(0).alias("label"), F.col("clean").alias("count")),
        F.struct(F.lit(1).alias("label"), F.col("buggy").alias("count")),
    )
    classes = counted.select(*keys, n.alias("n"), F.explode(each).alias("class"))
    return classes.select(*keys, "class.label", "class.count", F.try_divide("n", 2 * F.col("class.count")).alias("weight"))


def balanced_weights(rows: DataFrame) -> DataFrame:
    """``n / (classes * n_c)`` per class that occurs, for any number of classes."""
    counted = rows.groupBy("label").agg(F.count("*").alias("count"))
    whole = counted.agg(F.sum("count").cast("double").alias("n"), F.count("*").alias("classes")).first()
    return counted.withColumn("weight", F.lit(whole["n"]) / (whole["classes"] * F.col("count")))


def with_class_weight(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Two weights for the whole table are broadcast; with keys the planner goes by their size."""
    keys = [c for c in weights.columns if c not in ("label", "count", "weight")]
    wanted = weights.select(*keys, "label", "weight")
    return rows.join(wanted if keys else F.broadcast(wanted), [*keys, "label"], "left")
