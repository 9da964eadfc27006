import hashlib
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusops.operators import ranking, skew
from corpusops.operators import splits as S


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def rows_of(spark, sizes):
    rows = [(f"{g}-{i}", g, i % 2) for g, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "row_id string, grp string, label int").repartition(6)


def greedy(sizes, folds):
    """Each group, largest first, to the lightest fold."""
    loads, fold_of = [0] * folds, {}
    for g in sorted(sizes, key=lambda g: (-sizes[g], md5(f"42:{g}"))):
        fold_of[g] = loads.index(min(loads))
        loads[fold_of[g]] += sizes[g]
    return fold_of


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 9) | st.integers(1, 400), min_size=2, max_size=60), st.integers(2, 7))
def test_fold_plan_is_the_greedy_assignment(sizes, folds):
    histogram = {s: sizes.count(s) for s in sizes}
    loads, plan = [0] * folds, dict(S.fold_plan(histogram.items(), folds))
    for size in sorted(sizes, reverse=True):
        nth = histogram[size] = histogram[size] - 1
        nth = sizes.count(size) - nth
        first, taking = [t for t in plan[size] if t[0] <= nth][-1]
        fold = taking[(nth - first) % len(taking)]
        assert fold == loads.index(min(loads))
        loads[fold] += size


@pytest.mark.parametrize("hot", [0, 4000])
def test_group_kfold_is_greedy_and_covers_all_rows(spark, hot):
    rng = random.Random(3)
    sizes = {f"g{i}": rng.choice([1, 1, 2, 3, 5, 8]) for i in range(300)} | ({"hot": hot} if hot else {})
    folded = S.group_kfold(rows_of(spark, sizes), "grp")
    got = {r.grp: r.fold for r in folded.select("grp", "fold").distinct().collect()}
    assert got == greedy(sizes, 5)
    assert folded.count() == sum(sizes.values()) == folded.select("row_id").distinct().count()
    cover = S.fold_coverage(folded, "grp").first()
    assert (cover.rows, cover.groups, cover.groups_in_many_folds, cover.all_covered) == (sum(sizes.values()), len(sizes), 0, True)
    loads = {r.fold: r.rows for r in S.fold_loads(folded, "grp").collect()}
    assert max(loads.values()) - min(loads.values()) <= max(sizes.values())


def test_too_few_groups_for_the_folds(spark):
    with pytest.raises(ValueError, match="fewer groups"):
        S.group_kfold(rows_of(spark, {"a": 3, "b": 2}), "grp")


@pytest.mark.parametrize("groups", [1, 4, 5, 61, 700])
def test_holdout_takes_whole_groups(spark, groups):
    sizes = {f"g{i}": 1 + i % 3 for i in range(groups)}
    split = S.group_holdout(rows_of(spark, sizes), "grp")
    sides = {r.grp: r.split for r in split.select("grp", "split").distinct().collect()}
    assert len(sides) == groups
    test = {g for g, side in sides.items() if side == "test"}
    assert test == set(sorted(sizes, key=lambda g: md5(f"42:{g}"))[: math.ceil(0.2 * groups)])
    assert S.leaked_groups(split, "grp").count() == 0
    assert split.count() == sum(sizes.values())


def test_a_null_group_is_an_error(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "grp string, row_id int")
    for split in (lambda: S.group_holdout(df, "grp").collect(), lambda: S.group_kfold(df, "grp", 2).collect()):
        with pytest.raises(Exception, match="group is null"):
            split()


def test_leaks_are_listed(spark):
    rows = [("a", "X y", "train"), ("a", "p", "test"), ("b", "x   Y", "test"), ("c", "q", "train"), ("d", "q", "train")]
    df = spark.createDataFrame(rows, "grp string, text string, split string")
    assert [r.grp for r in S.leaked_groups(df, "grp").collect()] == ["a"]
    leak = S.leaked_texts(df, "text", "grp").collect()
    assert [(r.train_rows, r.test_rows, r.groups) for r in leak] == [(1, 1, 2)]


def test_balance_weights_and_baseline(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (1,)], "label int")
    row = S.class_balance(df).first()
    assert (row.clean, row.buggy, row.buggy_ratio) == (1, 3, 0.75)
    assert {r.label: r.weight for r in S.class_weights(df).collect()} == {0: 2.0, 1: pytest.approx(2 / 3)}
    base = S.majority_baseline(df).first()
    assert (base.majority_class, base.majority_baseline_accuracy) == (1, 0.75)
    tie = S.majority_baseline(df.where("label = 0").union(df.where("label = 1").limit(1))).first()
    assert (tie.majority_class, tie.majority_baseline_accuracy) == (0, 0.5)
    absent = {r.label: r.weight for r in S.class_weights(df.where("label = 1")).collect()}
    assert absent == {0: None, 1: 0.5}
    weighted = S.with_class_weight(df, S.class_weights(df))
    assert weighted.groupBy().agg(F.sum("weight")).first()[0] == pytest.approx(4)


def test_hash_rank_within_groups(spark):
    rows = [(g, md5(f"{g}/{i}")) for g, n in (("a", 1), ("b", 900), ("c", 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, key string").repartition(5)
    for by in ((), ("g",)):
        for r in ranking.hash_rank(df, "key", by=by, digits=2).collect():
            rivals = [k for g, k in rows if not by or g == r.g]
            assert r["rank"] == sorted(rivals).index(r.key) + 1


@pytest.mark.parametrize("fraction", [0.001, 0.2, 0.5, 1.0])
def test_key_at_fraction(spark, fraction):
    keys = sorted(md5(str(i)) for i in range(333))
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert ranking.key_at_fraction(df, "key", fraction).first().last_key == keys[math.ceil(fraction * 333) - 1]


def test_rows_of_a_heavy_key_are_spread_by_the_salted_join(spark):
    rows = spark.range(4000).withColumn("key", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    lookup = rows.groupBy("key").agg(F.count("*").alias("size")).withColumn("value", F.col("key") * 10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for joined in (
            skew.with_group_value(rows, lookup, "key", "value"),
            skew.salted_left_join(rows, lookup.select("key", "value"), "key"),
        ):
            held = joined.withColumn("task", F.spark_partition_id()).collect()
            assert len(held) == 4000 and all(r.value == r.key * 10 for r in held)
            assert len({r.task for r in held if r.key == 0}) == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])


def test_salted_join_spreads_repeated_rows_and_rows_without_a_key(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, 7).otherwise(F.col("id")).alias("key")).repartition(8)
    lookup = spark.createDataFrame([(7, "seven"), (2, "two")], "key long, value string")
    got = skew.salted_left_join(rows, lookup, "key")
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(lookup, "key", "left").collect()))
    counted = {r.key: r._ways for r in skew.heavy_keys(rows, "key").collect()}
    assert set(counted) == {7} and counted[7] == -(-1000 // (4000 // (16 * 8)))


def test_weights_of_many_classes(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (5,)], "label int")
    assert {r.label: r.weight for r in S.balanced_weights(df).collect()} == {0: 4 / 6, 1: 4 / 3, 5: 4 / 3}
