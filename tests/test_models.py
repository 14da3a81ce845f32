"""Training invariants: repeatable, bounded, saved and loaded without change."""

import pytest
from pyspark.sql import functions as F

from catalog.models import split_cohort
from outcomelab.operators import model as M
from outcomelab.operators.score import score_with
from outcomelab.operators.split import stratified_folds, stratified_split
from outcomelab.plans import experiments
from outcomelab.plans.order_cohort import order_cohort
from outcomelab.sources.models import load_and_score, load_model, save_model

NUMERIC = ("x", "z")


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(600).select(
        "id", (F.col("id") % 5 == 0).cast("int").alias("y"),
        (F.when(F.col("id") % 5 == 0, 2.0).otherwise(0.0) + F.rand(3)).alias("x"),
        F.when(F.col("id") % 11 != 0, F.rand(4)).alias("z"),
        F.when(F.col("id") % 2 == 0, "even").when(F.col("id") % 101 != 1, "it's odd")
        .otherwise("rare").alias("k"))
    df = stratified_split(df, "y", "id", 0.2, 0.2).persist()
    yield df
    df.unpersist()


def part(df, name):
    return df.where(F.col("split") == name)


def candidate(kind, **params):
    small = {"boosted": {"maxIter": 8, "maxDepth": 2}, "forest": {"numTrees": 5, "maxDepth": 3},
             "logistic": {"maxIter": 30}}[kind]
    return M.Candidate(kind, kind, NUMERIC, ("k",), {**small, **params})


@pytest.mark.parametrize("kind", ["forest", "logistic"])
def test_fit_is_repeatable_and_scores_are_probabilities(spark, table, kind):
    first, second = (
        score_with(M.fit(candidate(kind), part(table, "train"), "y"), part(table, "test"),
                   ["id", "y"]).orderBy("id").collect() for _ in range(2))
    assert [r["score"] for r in first] == pytest.approx([r["score"] for r in second])
    assert all(0 <= r["score"] <= 1 for r in first)
    assert all(r["pred"] == int(r["score"] > 0.5) for r in first)
    hits = sum(r["pred"] == r["y"] for r in first)
    assert hits / len(first) > 0.95


def test_boosting_stops_early(table):
    fitting = table.where("split <> 'test'").withColumn("held", F.col("split") == "val")
    model = M.fit(candidate("boosted", maxIter=12), fitting, "y", "held")
    assert 1 <= model.stages[-1].getNumTrees <= 12


def test_logistic_strength_and_unknown_learner():
    made = M.learner("logistic", "y", 200.0)
    assert made.getRegParam() == pytest.approx(1 / 200) and not made.getStandardization()
    with pytest.raises(ValueError, match="unknown learner"):
        M.learner("svm", "y", 1.0)


def test_preparation_handles_missing_rare_and_unseen(spark, table):
    prep = M.fit_preparation(part(table, "train"), NUMERIC, ("k",), min_frequency=20)
    odd = spark.createDataFrame([(1.0, None, "never seen"), (1.0, 0.5, "it's odd")],
                                "x double, z double, k string")
    vectors = [r["features"].toArray().tolist() for r in prep.transform(odd).collect()]
    names = M.feature_names(prep, table)
    assert len(names) == len(vectors[0])
    assert names[:2] == ["x_in", "z_in"]
    assert sum(vectors[0][2:]) == 0 and sum(vectors[1][2:]) == 1
    assert all(v == v for v in vectors[0])


def test_saved_model_scores_the_same(spark, table, tmp_path):
    path = str(tmp_path / "model")
    model = M.fit(candidate("forest"), part(table, "train"), "y")
    save_model(model, path, spark, params={"numTrees": 5}, metrics={"roc_auc": 0.9}, seed=7,
               features=M.feature_names(model, table))
    _, meta = load_model(path, spark)
    assert meta["best_params"] == {"numTrees": 5} and meta["random_state"] == 7
    assert meta["best_iteration"] == 5 and len(meta["feature_names"]) >= 3
    before = score_with(model, part(table, "test"), ["id"]).orderBy("id").collect()
    after = load_and_score(path, part(table, "test"), ["id"]).orderBy("id").collect()
    assert before == after
    handed_in = experiments.score_saved(path, part(table, "test"), "id", value_name="y")
    assert handed_in.columns == ["id", "y"] and handed_in.count() == len(before)


def test_cross_validation_table(table):
    folded = stratified_folds(table, "y", "id", 3)
    scores = M.cross_validate([candidate("logistic")], folded, "y", "fold")
    rows = scores.collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2]
    assert all(0.9 < r["auc"] <= 1 for r in rows)
    summary = M.cv_summary(scores).first()
    mean = sum(r["auc"] for r in rows) / 3
    assert summary["mean_auc"] == pytest.approx(mean)
    assert summary["std_auc"] == pytest.approx((sum((r["auc"] - mean) ** 2 for r in rows) / 3) ** .5)


def test_best_model_first_wins_ties(spark):
    scores = spark.createDataFrame([("a", 0, .8), ("b", 0, .8), ("c", 0, .7)],
                                   "model string, fold int, auc double")
    assert M.best_model(scores, ["b", "a", "c"]) == "b"


def test_draws_stay_in_range_and_repeat():
    for name, space in M.SPACES.items():
        draws = M.draw(space, 20, 1)
        assert draws == M.draw(space, 20, 1) != M.draw(space, 20, 2), name
        for d in draws:
            for key, (kind, *limits) in space.items():
                ok = d[key] in limits if kind == "choice" else \
                    limits[0] - 1e-12 <= d[key] <= limits[1] + 1e-12
                assert ok, (name, key, d[key])


def test_search_returns_the_best_trial(table):
    space = {"maxDepth": ("int", 1, 4)}
    best, log = M.search(candidate("forest"), space, part(table, "train"), "y", 3,
                         validate=part(table, "val"))
    rows = log.collect()
    top = max(rows, key=lambda r: (r["value"], -r["trial"]))
    assert str(best.params["maxDepth"]) == top["params"]["maxDepth"]
    with pytest.raises(ValueError, match="either"):
        M.search(candidate("forest"), space, table, "y", 1)


def test_importance_shares(spark):
    table = spark.createDataFrame([("a", 6.0), ("b", 3.0), ("c", 1.0), ("d", 0.0)],
                                  "feature string, importance double")
    rows = M.importance_shares(table, 3).orderBy("cum_pct").collect()
    assert [r["share_pct"] for r in rows] == pytest.approx([60, 30, 10])
    assert M.features_to_reach(M.importance_shares(table, 3), 80).first()[0] == 2


def test_full_experiment_and_comparison(table, tmp_path):
    raw = table.drop("split")
    result = experiments.full_experiment(raw, "y", "id", candidate("boosted"),
                                         save_to=str(tmp_path / "m"))
    metrics = {r["metric"]: r["value"] for r in result.metrics.collect()}
    assert metrics["roc_auc"] > 0.95 and result.importance.count() > 0
    assert result.thresholds.count() == 4 and result.scenarios.count() == 3
    name, scores, handed_in = experiments.baseline_comparison(
        part(table, "train").drop("split"), part(table, "test"), "y", "id",
        [candidate("logistic"), candidate("forest")], folds=2)
    assert name in ("logistic", "forest") and scores.count() == 4
    assert handed_in.count() == part(table, "test").count()


def test_one_rule_for_unseen_levels_however_many_rare_ones(spark, table, monkeypatch):
    """Listed in the SQL or joined from a table: rare is rare, unseen is nothing."""
    odd = spark.createDataFrame([(1.0, 0.5, k) for k in ("never seen", "rare", "it's odd", None)],
                                "x double, z double, k string")
    train = part(table, "train").withColumn("k", F.when(F.col("id") % 4 != 1, F.col("k")).otherwise(
        F.concat(F.lit("own "), "id")))
    found = []
    for limit in (10_000, 3):
        monkeypatch.setattr(M, "MAX_LEVELS", limit)
        prep = M.fit_preparation(train, NUMERIC, ("k",), min_frequency=20)
        names = M.feature_names(prep, train)
        assert names[2:] == sorted(names[2:]) and len(names) == 5
        found.append([r["features"].toArray()[2:].tolist() for r in prep.transform(odd).collect()])
    assert sum(found[0][0]) == 0 and sum(sum(v) for v in found[0]) == 3
    assert sorted(found[0]) == sorted(found[1])
    joined = prep.transform(train.withColumn("extra", F.lit(1)))
    assert joined.count() == train.count() and "__rare_k" not in joined.columns


def test_preparation_is_fitted_once_a_fold(table, monkeypatch):
    folded = stratified_folds(table, "y", "id", 2)
    calls = []
    plain = M.fit_preparation
    monkeypatch.setattr(M, "fit_preparation", lambda *a, **k: calls.append(1) or plain(*a, **k))
    space = {"maxDepth": ("choice", 2, 3, 4), "numTrees": ("choice", 3, 4)}
    settings = M.draw(space, 3, 42)
    base = candidate("forest")
    _, log = M.search(base, space, folded, "y", 3, fold="fold")
    assert len(calls) == 2
    for r in log.collect():        # the same values as with everything fitted anew
        trial = M.Candidate(**{**base.__dict__, "params": {**base.params, **settings[r["trial"]]}})
        aucs = [M.auc_of(M.fit(trial, folded.where(F.col("fold") != k), "y"), folded.where(F.col("fold") == k), "y")
                for k in (0, 1)]
        assert r["value"] == pytest.approx(sum(aucs) / 2, abs=0.02)
    calls.clear()
    pair = [candidate("forest"), M.Candidate(**{**base.__dict__, "name": "deep", "params": {"numTrees": 3, "maxDepth": 4}}),
            candidate("logistic")]
    scores = M.cross_validate(pair, folded, "y", "fold").collect()
    assert len(calls) == 4 and len(scores) == 6 and {r["model"] for r in scores} == {x.name for x in pair}


def test_the_cohort_is_joined_once_for_all_parts(spark, folder):
    parts = split_cohort(spark, folder)
    assert parts.count() == order_cohort(spark, folder).count()
    assert not any("lineitem" in f for f in parts.inputFiles())


def test_scores_are_held_while_they_are_judged(table, monkeypatch):
    seen, judge = [], M.metrics
    monkeypatch.setattr(M, "metrics", lambda df, *a: seen.append(df.storageLevel.useMemory) or judge(df, *a))
    model = M.fit(candidate("logistic"), part(table, "train"), "y")
    assert set(M.evaluate_fit(model, part(table, "val"), "y")) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
    assert seen == [True]


def test_cross_validation_holds_its_tables_on_disk(table, monkeypatch):
    frame, held = type(table), []
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: held.append((self.columns, a)) or persist(self, *a))
    folded = stratified_folds(table.drop("split"), "y", "id", 2)
    M.cross_validate([candidate("logistic"), candidate("forest")], folded, "y", "fold")
    levels = [a[0] for columns, a in held if M.FEATURES in columns or "fold" in columns]
    assert len(levels) == 2 * 2 * 2 + 1             # train and test of each preparation and fold, and the medians
    assert all(level.useDisk and not level.useMemory for level in levels)


def test_logistic_blocks_are_small_unless_told(table):
    assert M.learner("logistic", "y", 200.0).getMaxBlockSizeInMB() == 0.25
    assert M.learner("logistic", "y", 200.0, maxBlockSizeInMB=1.0).getMaxBlockSizeInMB() == 1.0
