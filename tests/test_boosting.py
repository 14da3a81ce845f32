"""Boosted trees beside a plain learner that recounts every split from the rows."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from outcomelab.operators import boosting as B
from outcomelab.operators import model as M

SMALL = B.BoostParams(rounds=3, leaves=6, depth=4, rate=0.3, l2=1.0, min_rows=5, bins=8, metric="loss")


def made(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.choice([None, float("nan"), *map(float, range(12))]), rng.random()
        c = rng.choice([0.0, 1.0, None])
        y = int((a or 0) == (a or 0) and ((a or 0) > 6) != (b > .7) or (c is None and rng.random() < .6))
        rows.append((i, y, a, b, c, rng.choice([1.0, 2.0])))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(made(), "id long, y int, a double, b double, c double, w double").persist()
    yield df
    df.unpersist()


def bins_of(row, edges):
    return [0 if x is None or x != x else 1 + sum(x > e for e in own) for x, own in zip(row[2:5], edges)]


def plain_tree(rows, p, features):
    """Best leaf first, from rows of (bins, g, h)."""
    def worth(part):
        g, h = sum(r[1] for r in part) / B.SCALE, sum(r[2] for r in part) / B.SCALE
        kept = max(abs(g) - p.l1, 0)
        return kept * kept / (h + p.l2) if h + p.l2 else 0.0

    def best(part):
        found = None
        for f in features:
            for b in sorted({r[0][f] for r in part} - {0}):
                for left_missing in (True, False):
                    left = [r for r in part if (r[0][f] <= b if left_missing else 0 < r[0][f] <= b)]
                    right = [r for r in part if not (r[0][f] <= b if left_missing else 0 < r[0][f] <= b)]
                    if min(len(left), len(right)) < max(1, p.min_rows) or any(
                            sum(r[2] for r in s) < p.min_hessian * B.SCALE for s in (left, right)):
                        continue
                    gain = worth(left) + worth(right) - worth(part)
                    key = (gain, -f, -b, left_missing)
                    if gain > p.min_gain and (found is None or key > found[0]):
                        found = (key, left, right)
        return found

    leaves = {1: (rows, 0)}
    splits, known = {}, {}
    while len(leaves) < p.leaves:
        for k in leaves:
            if k not in known:
                known[k] = best(leaves[k][0]) if leaves[k][1] < p.depth else None
        able = [k for k in leaves if known[k]]
        if not able:
            break
        k = min(able, key=lambda k: (-known[k][0][0], k))
        part, depth = leaves.pop(k)
        (gain, f, b, m), left, right = known[k]
        splits[k] = (-f, -b, m, gain, len(part))
        leaves[2 * k], leaves[2 * k + 1] = (left, depth + 1), (right, depth + 1)
    values = {}
    for k, (part, _) in leaves.items():
        g, h = sum(r[1] for r in part) / B.SCALE, sum(r[2] for r in part) / B.SCALE
        values[k] = -math.copysign(max(abs(g) - p.l1, 0), g) / (h + p.l2) * p.rate
    return splits, values


def follow(splits, values, bins):
    k = 1
    while k in splits:
        f, b, m, *_ = splits[k]
        k = 2 * k + (0 if (bins[f] <= b if m else 0 < bins[f] <= b) else 1)
    return values[k]


def half_up(x):
    return int(math.floor(x + .5)) if x >= 0 else -int(math.floor(-x + .5))


@pytest.mark.parametrize("params", [SMALL, B.BoostParams(
    rounds=3, leaves=4, depth=2, rate=0.5, l1=0.5, l2=0.1, min_rows=20, bins=5, metric="loss")])
def test_trees_equal_a_plain_learner(spark, table, params):
    model = B.fit_boosted(table, ["a", "b", "c"], "y", params, weight="w")
    rows = made()
    edges = [model.edges[c] for c in ("a", "b", "c")]
    binned = [bins_of(r, edges) for r in rows]
    share = sum(r[1] * r[5] for r in rows) / sum(r[5] for r in rows)
    margins = [math.log(share / (1 - share))] * len(rows)
    assert len(model.trees) == 3
    for tree in model.trees:
        part = []
        for r, bins, m in zip(rows, binned, margins):
            q = 1 / (1 + math.exp(-m))
            part.append((bins, half_up((q - r[1]) * r[5] * B.SCALE), half_up(q * (1 - q) * r[5] * B.SCALE)))
        splits, values = plain_tree(part, params, range(3))
        got = {n["node"]: (n["feature"], n["bin"], n["missing_left"], n["gain"], n["rows"]) for n in tree
               if n["feature"] is not None}
        assert set(got) == set(splits)
        for k in got:
            assert got[k][:3] == splits[k][:3] and got[k][4] == splits[k][4]
            assert got[k][3] == pytest.approx(splits[k][3], rel=1e-12)
        assert {n["node"]: n["value"] for n in tree if n["feature"] is None} == pytest.approx(values)
        margins = [m + follow(splits, values, b) for m, b in zip(margins, binned)]
    scores = {r["id"]: r["score"] for r in model.score(table).collect()}
    assert [scores[r[0]] for r in rows] == pytest.approx([1 / (1 + math.exp(-m)) for m in margins])


def test_same_trees_however_rows_are_dealt(table):
    one = replace(SMALL, rounds=1)
    first = B.fit_boosted(table.repartition(7, "id"), ["a", "b"], "y", one)
    second = B.fit_boosted(table.orderBy(F.desc("b")).coalesce(1), ["a", "b"], "y", one)
    assert first.trees == second.trees and first.trees


def test_stops_exactly_at_patience_and_returns_to_the_best_round(table):
    p = B.BoostParams(rounds=30, patience=2, leaves=6, rate=1.5, min_rows=2, bins=16, metric="loss")
    held = table.withColumn("held_out", F.col("id") % 3 == 0)
    model = B.fit_boosted(held, ["a", "b", "c"], "y", p, "held_out")
    best = max(range(len(model.history)), key=lambda i: (model.history[i], -i)) + 1
    assert len(model.history) == best + 2 < 30
    assert model.best_round == best == len(model.trees)


def test_auc_metric_giving_up_and_samples(table):
    held = table.withColumn("held_out", F.col("id") % 4 == 0)
    p = B.BoostParams(rounds=4, leaves=4, min_rows=5, bins=8, feature_share=.5, row_share=.6)
    seen = []
    model = B.fit_boosted(held, ["a", "b", "c"], "y", p, "held_out", id_column="id",
                          after_round=lambda r, v: seen.append((r, v)) or r == 2)
    assert [r for r, _ in seen] == [1, 2] and seen[1][1] == model.history[1]
    assert all(0 <= v <= 1 for v in model.history)
    for tree in model.trees:
        assert len({n["feature"] for n in tree} - {None}) <= 2
        assert 100 < tree[0]["rows"] < 260          # about 0.6 of 300 rows
    again = B.fit_boosted(held, ["a", "b", "c"], "y", p, "held_out", id_column="id", after_round=lambda r, v: r == 2)
    assert again.trees == model.trees
    with pytest.raises(ValueError):
        B.fit_boosted(held, ["a"], "y", p)


def test_saved_model_scores_the_same(spark, table, tmp_path):
    model = B.fit_boosted(table, ["a", "b", "c"], "y", replace(SMALL, rounds=2))
    B.save_boosted(model, str(tmp_path / "m"), spark)
    odd = spark.createDataFrame([(1, None, None, None), (2, 1e9, -1e9, None)], "id long, a double, b double, c double")
    a, b = (x.score(odd).orderBy("id").collect() for x in (model, B.load_boosted(str(tmp_path / "m"), spark)))
    nan = model.score(odd.where("id = 2").withColumn("c", F.lit(float("nan")))).first()["score"]
    assert a == b and nan == a[1]["score"] and all(0 < r["score"] < 1 for r in a)


def test_empty_table_and_one_class(spark, table):
    empty = B.fit_boosted(table.limit(0), ["a"], "y", SMALL)
    assert empty.trees == [] and empty.score(table).first()["score"] == 0.5
    one = B.fit_boosted(table.withColumn("y", F.lit(1)), ["a"], "y", SMALL)
    assert one.score(table).first()["score"] > 0.99


def test_importance_is_a_walk_of_the_trees(spark, table):
    model = B.fit_boosted(table, ["a", "b", "c"], "y", SMALL)
    want = {}
    for tree in model.trees:
        for n in tree:
            if n["feature"] is not None:
                want[model.features[n["feature"]]] = want.get(model.features[n["feature"]], 0) + n["gain"]
    got = {r["feature"]: r for r in B.node_importance(model.nodes(spark)).collect()}
    assert {k: r["importance"] for k, r in got.items()} == pytest.approx(want)
    assert sum(r["share_pct"] for r in got.values()) == pytest.approx(100)
    counts = B.node_importance(model.nodes(spark), "split").collect()
    assert sum(r["importance"] for r in counts) == sum(r["splits"] for r in got.values())


def test_node_table_of_a_spark_forest_gives_its_own_importance(spark, table):
    forest = M.fit(M.Candidate("f", "forest", ("a", "b", "c"), (), {"numTrees": 4, "maxDepth": 3}, weighted=False),
                   table, "y")
    last = forest.stages[-1]
    names = M.feature_names(forest, table)
    nodes = B.ensemble_nodes(last, names, spark)
    assert nodes.where("feature IS NULL").count() == nodes.where("feature IS NOT NULL").count() + 4
    # Spark's own importance: gains per tree scaled to 1, summed over the trees, scaled to 1.
    share = {}
    for t in range(4):
        rows = nodes.where(F.col("tree") == t).where("feature IS NOT NULL").collect()
        total = sum(r["gain"] for r in rows)
        for r in rows:
            share[r["feature"]] = share.get(r["feature"], 0) + r["gain"] / total / 4
    assert [share.get(n, 0.0) for n in names] == pytest.approx(last.featureImportances.toArray().tolist())


def test_bins_are_found_by_search_and_closed_on_the_right(spark):
    inf = float("inf")
    edges = {"a": [-inf, -1.5, 0.0, 2.0, inf], "b": [], "c": [1.7976931348623157e308]}
    xs = [None, float("nan"), -inf, -2.0, -1.5, -0.0, 0.0, 1e-300, 2.0, 2.5, inf]
    df = spark.createDataFrame([(x, x, x) for x in xs], "a double, b double, c double")
    got = [r["bins"] for r in B.with_bins(df, ["a", "b", "c"], edges).collect()]
    assert got == [[0 if x is None or x != x else 1 + sum(x > e for e in edges[c]) for c in "abc"] for x in xs]
    # A ladder of comparisons per column is too long a method for the compiler of the executors.
    plan = B.with_bins(df, ["a"], {"a": [float(i) for i in range(60)]})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<=") < 10


def test_target_statistics_of_a_fit_are_made_once(spark, folder):
    from catalog import learning

    rows = learning.fitting(spark, folder)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    assert rows.count() == spark.read.parquet(f"{folder}/orders.parquet").count()
