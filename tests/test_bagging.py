"""Out-of-bag scores equal a replay of the draws, tree by tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from outcomelab.operators import bagging as G


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(300).select(
        "id", (F.col("id") % 3 == 0).cast("int").alias("y"),
        (F.when(F.col("id") % 3 == 0, 1.0).otherwise(0.0) + F.rand(3)).alias("x"), F.rand(4).alias("z")).persist()
    yield df
    df.unpersist()


def draw(i, tree, seed=42):
    inner = hashlib.md5(f"{'' if i is None else i}|{seed}".encode()).hexdigest()
    u = int(hashlib.md5(f"{inner}|{tree}".encode()).hexdigest()[:12], 16) / (1 << 48)
    return next((k for k, p in enumerate(G.POISSON) if u < p), len(G.POISSON))


def test_draws_are_poisson_and_replayable(spark):
    rows = spark.range(5000).select("id", G.bootstrap_draw("id", 3).alias("d")).collect()
    assert all(r["d"] == draw(r["id"], 3) for r in rows)
    assert abs(sum(r["d"] for r in rows) / 5000 - 1) < .05 and abs(sum(r["d"] == 0 for r in rows) / 5000 - .368) < .03
    lone = spark.createDataFrame([(None,)], "id long").select(G.bootstrap_draw("id", 0).alias("d")).first()["d"]
    assert lone == draw(None, 0)


def test_out_of_bag_scores_are_those_of_trees_that_missed_the_row(spark, table):
    forest = G.fit_bagged_forest(table, "y", "id", ["x", "z"], trees=4, depth=3, weighted=False)
    got = {r["id"]: r["oob_score"] for r in forest.out_of_bag(table, "id").collect()}
    ready = forest.preparation.transform(table)
    votes = [{r["id"]: float(r["probability"][1]) for r in tree.transform(ready).collect()} for tree in forest.trees]
    hits = n = 0
    for r in table.collect():
        missed = [votes[k][r["id"]] for k in range(4) if draw(r["id"], k) == 0]
        want = sum(missed) / len(missed) if missed else None
        assert got[r["id"]] == (pytest.approx(want) if missed else None)
        if missed:
            n += 1
            hits += (want > .5) == r["y"]
    assert forest.oob["rows"] == n and forest.oob["accuracy"] == pytest.approx(hits / n)
    assert 0.8 < forest.oob["roc_auc"] <= 1
    scored = {r["id"]: r["score"] for r in forest.score(table).collect()}
    assert scored == pytest.approx({i: sum(v[i] for v in votes) / 4 for i in votes[0]})
