"""The sampler on a known surface, pruned trials, reloads, and the stepwise tuner under a fake clock."""

import math
import random

import pytest
from pyspark.sql import functions as F

from outcomelab.operators import boosting as B
from outcomelab.operators import tuning as U
from outcomelab.operators.model import draw

SPACE = {"x": ("float", -5.0, 5.0), "n": ("int", 1, 50), "r": ("log", 1e-4, 1.0), "c": ("choice", "a", "b", "c")}


def surface(p):
    return -(p["x"] - 2) ** 2 - ((p["n"] - 30) / 10) ** 2 - math.log(p["r"] / 0.01) ** 2 / 4 - (p["c"] != "b")


def run(seed, n, startup=10):
    study = U.Study(SPACE, seed, startup)
    for _ in range(n):
        t = study.ask()
        study.tell(t, surface(t.params))
    return study


def test_same_seed_same_trials_and_all_in_range():
    one, two = run(3, 30), run(3, 30)
    assert [t.params for t in one.trials] == [t.params for t in two.trials]
    assert [t.params for t in one.trials] != [t.params for t in run(4, 30).trials]
    for t in one.trials:
        p = t.params
        assert -5 <= p["x"] <= 5 and p["n"] in range(1, 51) and 1e-4 <= p["r"] <= 1 and p["c"] in "abc"
        assert isinstance(p["n"], int)


def test_beats_random_draws_on_a_known_surface():
    wins = 0
    for seed in range(12):
        ours = run(seed, 60).best.value
        wins += ours > max(surface(p) for p in draw(SPACE, 60, seed))
    assert wins >= 10


def test_a_reloaded_study_goes_on_alike():
    whole = run(5, 40)
    first = U.Study.from_json(run(5, 25).to_json())
    for _ in range(15):
        t = first.ask()
        first.tell(t, surface(t.params))
    assert [t.params for t in first.trials] == [t.params for t in whole.trials]


def rounds(p, n=20):
    """Values that climb towards the surface's value, so a bad trial is bad early."""
    return [surface(p) - 3 / (k + 1) for k in range(n)]


def search(prune):
    study = U.Study(SPACE, 1, startup=100, prune=prune)
    for _ in range(40):
        t = study.ask()
        pruned = False
        for v in rounds(t.params):
            pruned = study.hopeless(t, v)
            if pruned:
                break
        study.tell(t, max(t.values), pruned)
    return study


def test_pruned_trials_keep_their_rounds_and_the_winner_stays(spark):
    plain, pruned = search(False), search(True)
    assert plain.best.params == pruned.best.params and plain.best.value == pruned.best.value
    log = pruned.log(spark)
    gone = log.where("state = 'pruned'").collect()
    assert 8 <= len(gone) < 40 and all(1 <= r["rounds"] == len(r["values"]) < 20 for r in gone)
    assert log.where("state = 'done' AND rounds = 20").count() == 40 - len(gone)
    assert all(t.state == "done" for t in pruned.trials[:5])


def test_median_rule():
    study = U.Study(SPACE, prune=True, warm_trials=3, warm_rounds=1)
    for v in (1.0, 2.0, 3.0):
        t = study.ask()
        assert not study.hopeless(t, v) and not study.hopeless(t, v)
        study.tell(t, v)
    t = study.ask()
    assert not study.hopeless(t, 1.5)       # the first round never ends a trial
    assert study.hopeless(t, 1.9) and not study.hopeless(t, 2.0)


def test_stepwise_carries_the_best_and_stops_on_budget():
    stages = [("a", lambda best, rng: [{"a": k} for k in (1, 5, 9)]),
              ("b", lambda best, rng: [{"b": best["a"] + d} for d in (-1, 0, 1)])]
    value = lambda p: -abs(p.get("a", 0) - 5) - abs(p.get("b", 0) - 6)
    best, log = U.tune_stepwise(value, {}, stages)
    assert best == {"a": 5, "b": 6} and [x[0] for x in log] == ["start", *"aaabbb"]
    assert [x[4] for x in log] == sorted(x[4] for x in log)
    ticks = iter(range(100))
    best, log = U.tune_stepwise(value, {}, stages, budget=4, clock=lambda: next(ticks))
    assert [x[0] for x in log] == ["start", "a", "a", "a"] and best == {"a": 5}
    names = [n for n, _ in U.BOOST_STAGES]
    _, log = U.tune_stepwise(lambda p: random.Random(str(sorted(p.items()))).random(), {})
    assert len(log) == 1 + 7 + 20 + 10 + 6 + 20 + 5 and list(dict.fromkeys(x[0] for x in log)) == ["start", *names]


def test_tuning_boosted_trees(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame([(i, int((a > .5) != (b > .5)), a, b) for i, a, b in rows], "id long, y int, a double, b double")
    df = df.withColumn("held", F.col("id") % 3 == 0)
    base = B.BoostParams(rounds=2, leaves=4, min_rows=5, bins=8, metric="loss", rate=0.5)
    study = U.Study({"depth": ("int", 1, 3)}, startup=2)
    path = str(tmp_path / "study")
    best, study = U.tune_boosted(df, ["a", "b"], "y", "held", study, 2, base, path=path)
    again = U.load_study(path, spark)
    assert [t.value for t in again.trials] == [t.value for t in study.trials]
    best, study = U.tune_boosted(df, ["a", "b"], "y", "held", again, 3, base)
    assert len(study.trials) == 3 and best.depth == study.best.params["depth"]
    assert all(len(t.values) <= 2 and t.value == max(t.values) for t in study.trials)
    stages = [("depth", lambda best, rng: [{"depth": 1}, {"depth": 2}])]
    found, log = U.tune_boosted_stepwise(df, ["a", "b"], "y", "held", base, stages=stages)
    assert log.count() == 3 and found.depth in (2, 12)
