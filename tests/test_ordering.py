"""The order kernels against brute force, with ties, hot values and small budgets."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outcomelab.operators import ordering
from outcomelab.operators.ordering import (
    pooled_steps, quantiles, ranked_rows, running_totals, sketch_edges, top_rows,
)

PROBS = [0.0, 0.1, 0.25, 0.5, 0.7, 0.99, 1.0]


def sample(kind, n=3000, seed=1):
    rng = random.Random(seed)
    if kind == "unique":
        return [rng.gauss(0, 1e6) for _ in range(n)]
    if kind == "third":                      # one value holds a third of all rows
        return [7.0 if i % 3 == 0 else rng.uniform(-100, 100) for i in range(n)]
    if kind == "few":
        return [float(rng.randint(0, 5)) for _ in range(n)]
    if kind == "constant":
        return [3.5] * n
    return [10.0 ** rng.uniform(-300, 300) for _ in range(n)]


@pytest.mark.parametrize("kind", ["unique", "third", "few", "constant", "wild"])
@pytest.mark.parametrize("budget", [10_000, 400])
def test_quantiles_match_numpy(spark, kind, budget):
    values = sample(kind)
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)] + [(None, 0)],
                               "x double, g int")
    got = quantiles(df, ["x"], PROBS, budget=budget, accuracy=100, batch=20)[(None, "x")]
    assert got == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)
    grouped = quantiles(df, ["x"], PROBS, by="g", budget=budget, accuracy=100, batch=20)
    for g in (0, 1):
        expected = np.quantile([v for i, v in enumerate(values) if i % 2 == g], PROBS)
        assert grouped[(g, "x")] == pytest.approx(list(expected), rel=1e-12)


def test_quantiles_of_nothing_and_of_nan(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 2.0)], "a double, b double")
    got = quantiles(df, ["a", "b"], [0.5])
    assert got == {(None, "a"): [None], (None, "b"): [2.0]}
    assert quantiles(df, ["a", "b"], [0.5], budget=1)[(None, "b")] == [2.0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-3, 3), min_size=30, max_size=60), st.integers(1, 20))
def test_quantiles_property(spark, values, budget):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = quantiles(df, ["x"], [0.3, 0.5], budget=budget, accuracy=20, batch=5)[(None, "x")]
    assert got == pytest.approx(list(np.quantile(values, [0.3, 0.5])))


@pytest.mark.parametrize("kind", ["unique", "third", "few", "constant"])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, kind, descending):
    values = sample(kind, 1000)
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)] + [(None, 1)],
                               "x double, w int")
    out = running_totals(df, "x", {"n": F.lit(1), "w": F.col("w")}, descending, buckets=16)
    rows = {r["x"]: r for r in out.collect()}
    before_n = before_w = 0
    for v in sorted(set(values), reverse=descending):
        r = rows.pop(v)
        assert (r["n_before"], r["w_before"]) == (before_n, before_w)
        assert r["n_total"] == len(values)
        before_n, before_w = before_n + r["n"], before_w + r["w"]
    assert not rows and before_n == len(values)


@pytest.mark.parametrize("kind", ["unique", "third", "few", "constant"])
def test_ranked_rows(spark, kind):
    values = sample(kind, 1000)
    rows = [(i, v) for i, v in enumerate(values)] + [(1000 + i, None) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double").repartition(5)
    rising = {r["id"]: r["rank"] for r in
              ranked_rows(df, "x", "id", descending=False, buckets=10).collect()}
    up = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0.0, r[0]))
    assert [rising[i] for i, _ in up] == list(range(1, len(rows) + 1))
    got = {r["id"]: r["rank"] for r in ranked_rows(df, "x", "id", buckets=10).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0) if r[1] is not None else 0,
                                        r[0]))
    assert [got[i] for i, _ in order] == list(range(1, len(rows) + 1))


def test_hot_key_is_spread_over_sub_buckets(spark):
    df = spark.range(3000).select("id", F.lit(0.5).alias("x"))
    ranked = ranked_rows(df, "x", "id", buckets=8)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__bucket" in plan and "__sub" in plan
    assert ranked.where(F.col("rank") == F.col("id") + 1).count() == 3000


def test_number_of_buckets_stays_bounded(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 12).cast("double").alias("x"))
    ranked = ranked_rows(df, "x", "id", buckets=50)
    assert ranked.agg(F.count_distinct("rank")).first()[0] == 20_000
    lines = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "__sub" in lines
    _, frequent = sketch_edges(df, "x", 50)
    assert len(frequent) == 12 and sum(frequent.values()) == 49


def test_top_rows_small_and_large_agree(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(500)], "id long, x double")
    small = top_rows(df, "x", "id", 40).orderBy("rank").collect()
    large = top_rows(df, "x", "id", 40, limit=10).orderBy("rank").collect()
    assert [(r["id"], r["rank"]) for r in small] == [(r["id"], r["rank"]) for r in large]
    assert top_rows(df, "x", "id", 1000).count() == 500


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_sketch_is_not_merged_in_one_task(spark):
    df = spark.range(0, 40_000, 1, 24).select(F.rand(3).alias("x"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        _, (edges, _) = jobs_of(spark, "sketch", lambda: sketch_edges(df, "x", 20))
    finally:
        spark.conf.set(coalesce, before)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("sketch")
              for s in tracker.getJobInfo(j).stageIds]
    assert min(s.numTasks for s in stages if s) > 1
    assert edges == pytest.approx([i / 20 for i in range(1, 20)], abs=0.03)


def test_pooled_steps():
    assert pooled_steps([], 4) == []
    assert pooled_steps([(9, [1.0, 2.0, 3.0])], 4) == [1.0, 2.0, 3.0]
    # A large group weighs more than a small one, and a group of one value fills its steps.
    assert pooled_steps([(1, [0.0, 0.0, 0.0]), (300, [5.0, 6.0, 7.0])], 4) == [5.0, 6.0, 7.0]
    assert pooled_steps([(10, [1.0, 1.0, 1.0]), (10, [2.0, 3.0, 4.0])], 4) == [1.0, 1.0, 3.0]


def test_sketch_of_unlike_partitions(spark):
    # Sorted over the partitions, one value on half of the rows, some groups without any value.
    df = spark.range(0, 4000, 1, 40).select(
        F.when(F.col("id") < 2000, F.col("id") / 10).when(F.col("id") < 3900, 1000.0).alias("x"))
    edges, frequent = sketch_edges(df, "x", 40)
    assert set(frequent) == {1000.0} and abs(frequent[1000.0] - 19) <= 2
    rows = np.array([min(i / 10, 200) if i < 2000 else 1000.0 for i in range(3900)])
    inside = np.histogram(rows, [-np.inf, *edges, np.inf])[0]
    assert sorted(inside)[-2] <= 3 * 3900 / 40
    assert sketch_edges(df.where("x IS NULL"), "x", 40) == ([], {})


def test_quantile_work_does_not_grow_with_their_number(spark):
    values = sample("unique", 2000)
    df = spark.createDataFrame([(v, -v) for v in values], "x double, z double")
    few, many = [0.5], [i / 60 for i in range(61)]
    small, _ = jobs_of(spark, "few", lambda: quantiles(df, ["x", "z"], few, budget=300, accuracy=100, batch=10))
    large, got = jobs_of(spark, "many", lambda: quantiles(df, ["x", "z"], many, budget=300, accuracy=100, batch=10))
    assert large <= small + 2
    assert got[(None, "x")] == pytest.approx(list(np.quantile(values, many)), rel=1e-12)
    assert got[(None, "z")] == pytest.approx(list(np.quantile([-v for v in values], many)), rel=1e-12)


def test_quantiles_with_infinities_signed_zeros_and_a_rare_group(spark):
    inf = float("inf")
    values = [-inf] * 40 + [inf] * 60 + [0.0, -0.0] * 50 + [1e308, -1e308, 5e-324] + [float(i) for i in range(54)]
    rows = [(v, "often") for v in values] + [(v, "rare") for v in (3.0, 1.0, 2.0)] + [(4.0, None)]
    df = spark.createDataFrame(rows, "x double, g string").repartition(3)
    probs = [i / 256 for i in range(257)]                # every rank of the frequent group
    got = quantiles(df, ["x"], probs, by="g", budget=20, accuracy=20)
    assert got[("often", "x")] == sorted(values)
    assert quantiles(df, ["x"], [0.0, 0.5, 1.0], by="g", budget=20, accuracy=20)[("rare", "x")] == [1.0, 2.0, 3.0]


def test_quantiles_outside_each_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 0, 1, 2, None]), rng.choice([None, float("nan"), 5.0, 5.0, rng.gauss(0, 9)]),
             float(i % 7) if i % 3 else None, None) for i in range(900)]
    df = spark.createDataFrame(rows, "fold int, x double, y double, empty double")
    probs, columns = [0.0, 0.3, 0.5, 1.0], ["x", "y", "empty"]
    for budget in (20, 100_000):
        got = ordering.quantiles_outside(df, columns, probs, "fold", budget=budget, accuracy=10)
        want = {(k, c): v for k in (0, 1, 2) for (_, c), v in ordering.quantiles(
            df.where(F.col("fold") != k), columns, probs, budget=budget, accuracy=10).items()}
        assert got == want
    assert ordering.quantiles_outside(df.where("fold = 1"), ["x"], [0.5], "fold") == {(1, "x"): [None]}


def test_folds_share_the_passes_of_a_quantile(spark, monkeypatch):
    passes = []
    refine = ordering._refine
    monkeypatch.setattr(ordering, "_refine", lambda *a: passes.append(1) or refine(*a))
    df = spark.range(3000).select((F.col("id") % 5).alias("fold"), F.sin("id").alias("x"))
    ordering.quantiles_outside(df, ["x"], [0.5], "fold", budget=2000)
    five = len(passes)
    ordering.quantiles_outside(df.withColumn("fold", F.col("fold") % 2), ["x"], [0.5], "fold", budget=1000)
    assert five == len(passes) - five
