"""Filling, scaling, encoding, weights, and exact stratified parts."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from outcomelab.operators import prep, split


def column(df, name, order=None):
    return [r[name] for r in (df.orderBy(order) if order else df).collect()]


def test_fill_strategies(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 4.0, None), (4, 10.0, None)],
                               "id int, x double, empty double")
    assert prep.fit_fill(df, "median", ["x", "empty"]) == {"x": 4.0}
    assert prep.fit_fill(df, "mean", ["x"]) == {"x": 5.0}
    assert column(prep.handle_missing(df, "median", columns=["x"]), "x", "id") == [1, 4, 4, 10]
    assert prep.handle_missing(df, "drop", columns=["x"]).count() == 3
    with pytest.raises(ValueError, match="unknown strategy"):
        prep.handle_missing(df, "zero")


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0), ("b", 1.0), ("a", 2.0), (None, None)],
                               "k string, x double")
    assert prep.fit_modes(df) == {"k": "a", "x": 1.0}
    filled = prep.apply_fill(df, prep.fit_modes(df))
    assert filled.where("k IS NULL OR x IS NULL").count() == 0


def test_mode_of_empty_column_is_skipped(spark):
    df = spark.createDataFrame([(None, 1.0)], "k string, x double")
    assert prep.fit_modes(df) == {"x": 1.0}


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    scaler = prep.fit_scaler(df, ["x", "c"])
    assert (scaler.mean["x"], scaler.scale["x"], scaler.scale["c"]) == (2.0, 1.0, 1.0)
    assert column(scaler.apply(df), "x") == [-1.0, 1.0]
    assert column(scaler.apply(df), "c") == [0.0, 0.0]


def test_codes_are_alphabetical_and_unseen_is_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    model = prep.fit_codes(train, ["k"])
    test = spark.createDataFrame([("a",), ("b",), (None,), ("zz",)], "k string")
    assert column(prep.apply_codes(test, model), "k_encoded") == [0, 1, 2, -1]


def test_one_hot_unseen_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "k string")
    model = Pipeline(stages=prep.one_hot_stages(["k"])).fit(train)
    out = model.transform(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"))
    assert [r["k_onehot"].toArray().tolist() for r in out.collect()] == \
        [[1, 0], [0, 1], [0, 0]]


def test_rare_levels_share_a_slot(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",), ("c",)], "k string")
    levels = prep.level_table(train, "k", 2)
    test = spark.createDataFrame([(1, "a"), (2, "b"), (3, "new"), (4, None)], "id int, k string")
    assert column(prep.group_rare_levels(test, levels, "k"), "k", "id") == \
        ["a", prep.INFREQUENT, None, None]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    got = {r["y"]: r for r in prep.class_weights(df, "y").collect()}
    assert got[0]["balanced"] == pytest.approx(10 / 18) and got[1]["balanced"] == 5
    assert got[1]["positive"] == 9 and got[0]["positive"] == 1
    weighted = prep.add_class_weight(df, "y")
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(10)


def labelled(spark, n=997, hot=None):
    return spark.range(n).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))


def counts(df, part):
    return {(r["y"], r[part]): r["count"] for r in df.groupBy("y", part).count().collect()}


def test_split_sizes_follow_the_rounding_rules():
    assert split.split_sizes([9000, 1000], 0.2) == [(1800,), (200,)]
    assert split.split_sizes([14000, 1000], 0.15, 0.15) == [(2100, 2100), (150, 150)]
    total = [sum(s) for s in zip(*split.split_sizes([897, 100], 0.2, 0.2))]
    assert total == [math.ceil(0.2 * 997), math.ceil(0.25 * (997 - 200))]
    assert split.allot(10, [1, 1, 1]) == [4, 3, 3]
    assert split.split_sizes([1], 0.2, 0.2) == [(1, 0)] and split.allot(0, [0]) == [0]


def test_three_way_split_is_exact_complete_and_repeatable(spark):
    df = labelled(spark)
    parts = split.stratified_split(df, "y", "id", 0.2, 0.2)
    sizes = split.split_sizes([897, 100], 0.2, 0.2)
    got = counts(parts, "split")
    for y, n, (test, val) in zip((0, 1), (897, 100), sizes):
        assert got[(y, "test")] == test and got[(y, "val")] == val
        assert got[(y, "train")] == n - test - val
    again = split.stratified_split(df.repartition(7), "y", "id", 0.2, 0.2)
    assert {tuple(r) for r in parts.collect()} == {tuple(r) for r in again.collect()}
    other = split.stratified_split(df, "y", "id", 0.2, 0.2, seed=1)
    assert {tuple(r) for r in parts.collect()} != {tuple(r) for r in other.collect()}


def test_folds_differ_by_at_most_one_row_per_class(spark):
    got = counts(split.stratified_folds(labelled(spark), "y", "id", 5), "fold")
    for y, n in ((0, 897), (1, 100)):
        sizes = [got[(y, k)] for k in range(5)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_repeated_ids_stay_together_and_nothing_is_lost(spark):
    df = labelled(spark, 300).unionByName(
        spark.range(150).select(F.lit(5).cast("long").alias("id"), F.lit(0).alias("y")))
    parts = split.stratified_split(df, "y", "id", 0.3)
    assert parts.count() == 450 and parts.where("split IS NULL").count() == 0
    assert parts.where("id = 5 AND y = 0").select("split").distinct().count() == 1


def test_split_moves_no_rows(spark):
    parts = split.stratified_split(labelled(spark), "y", "id", 0.2)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_rows_without_label_get_no_part(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 0)], "id long, y int")
    parts = split.stratified_split(df, "y", "id", 0.5)
    assert column(parts.where("y IS NULL"), "split") == [None]
    report = {r["split"]: r["n"] for r in split.split_report(parts, "y").collect()}
    assert sum(report.values()) == 4
