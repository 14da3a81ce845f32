"""K, A5, J2: training, search, importance and saved models, on the order cohort.

Training is not expressible in SQL, so these are checked by their rows here and by
invariants in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelab.operators import model as M
from outcomelab.operators.score import score_with
from outcomelab.operators.split import stratified_folds, stratified_split
from outcomelab.plans import experiments
from outcomelab.plans.order_cohort import order_cohort, season_table
from outcomelab.plans.recipes import PLAYER_SEASON
from outcomelab.session import stored
from outcomelab.sources.models import load_and_score, load_model, save_model

from .registry import check
from .sources import scratch

NUMERIC = ("n_lines", "qty", "price", "avg_disc", "avg_tax", "returned", "balance", "score")
SMALL = {"boosted": {"maxIter": 10, "maxDepth": 3}, "forest": {"numTrees": 10, "maxDepth": 5},
         "logistic": {"maxIter": 50}}


def candidate(kind: str, name: str | None = None, **params) -> M.Candidate:
    return M.Candidate(name or kind, kind, NUMERIC, ("segment",),
                       {**SMALL[kind], **params}, encode="onehot")


def split_cohort(spark, sf):
    c = stored(order_cohort(spark, sf).select("id", "label", "segment", "grp", *NUMERIC))
    return stratified_split(c, "label", "id", 0.2, 0.2)


def part(df, *names):
    return df.where(F.col("split").isin(*names))


@check("K1_boosted_early_stop")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    fitting = part(parts, "train", "val").withColumn("is_val", F.col("split") == "val")
    model = M.fit(candidate("boosted", maxIter=15), fitting, "label", "is_val")
    return score_with(model, part(parts, "test"), ["id", "label"])


@check("K2_random_forest")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    return score_with(M.fit(candidate("forest"), part(parts, "train"), "label"),
                      part(parts, "test"), ["id", "label"])


@check("K2_forest_with_index_codes")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    wide = M.Candidate("forest", "forest", NUMERIC, ("segment", "grp"), SMALL["forest"],
                       encode="index", min_frequency=None)
    return score_with(M.fit(wide, part(parts, "train"), "label"),
                      part(parts, "test"), ["id", "label"])


@check("K3_logistic_regression")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    return score_with(M.fit(candidate("logistic"), part(parts, "train"), "label"),
                      part(parts, "test"), ["id", "label"])


@check("K4_cross_validation")
def _(spark, sf):
    c = stored(order_cohort(spark, sf).select("id", "label", "segment", *NUMERIC))
    folded = stratified_folds(c, "label", "id", 5)
    scores = M.cross_validate([candidate("logistic"), candidate("forest", numTrees=5)],
                              folded, "label", "fold", parallelism=4)
    return M.cv_summary(scores).select("model", "mean_auc", "std_auc")


@check("K5_search_on_validation")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    _, log = M.search(candidate("boosted", maxIter=5), {**M.SPACES["boosted"],
                                                        "maxDepth": ("int", 3, 5)},
                      part(parts, "train"), "label", 3, validate=part(parts, "val"))
    return log.select("trial", "value")


@check("K5_search_by_folds")
def _(spark, sf):
    c = stored(order_cohort(spark, sf).select("id", "label", "segment", *NUMERIC))
    folded = stratified_folds(c, "label", "id", 2)
    space = {**M.SPACES["forest"], "numTrees": ("int", 3, 8), "maxDepth": ("int", 3, 6)}
    _, log = M.search(candidate("forest"), space, folded, "label", 2, fold="fold",
                      objective="f1")
    return log.select("trial", "value")


@check("K6_refit_on_train_and_validation")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    model = experiments.refit_on_all(candidate("logistic"), part(parts, "train"),
                                     part(parts, "val"), "label")
    return score_with(model, part(parts, "test"), ["id", "label"])


@check("K7_feature_importance")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    return M.feature_importance(M.fit(candidate("forest"), part(parts, "train"), "label"),
                                parts, top=10)


@check("A5_saved_model_metadata")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    path = scratch(spark) + "/model"
    model = M.fit(candidate("forest"), part(parts, "train"), "label")
    save_model(model, path, spark, params=SMALL["forest"],
               metrics=M.evaluate_fit(model, part(parts, "val"), "label"),
               features=M.feature_names(model, parts))
    _, meta = load_model(path, spark)
    return spark.createDataFrame([(k, float(v)) for k, v in meta["metrics"].items()],
                                 "metric string, value double")


@check("J2_load_and_score")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    path = scratch(spark) + "/model"
    save_model(M.fit(candidate("logistic"), part(parts, "train"), "label"), path, spark)
    return load_and_score(path, part(parts, "test"), ["id", "label"], 0.5)


@check("K1_full_experiment")
def _(spark, sf):
    s = stored(season_table(spark, sf))
    player = M.Candidate(
        "player", "boosted",
        ("GP", "usg", "eFG", "TS_per", "bpm", "pts", "efficiency_score", "all_around_score_v2",
         "pts_per_min", "usage_efficiency", "versatile_guard", "power_conference"),
        ("type", "yr"), {"maxIter": 5, "maxDepth": 3}, encode="index", min_frequency=None)
    return experiments.full_experiment(s, "drafted", "player_id", player, PLAYER_SEASON).thresholds


@check("K4_baseline_comparison")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    _, _, table = experiments.baseline_comparison(
        part(parts, "train", "val").drop("split"), part(parts, "test"), "label", "id",
        [candidate("logistic"), candidate("forest", numTrees=4)], folds=2)
    return table
