"""Scores, metrics and decision tables on hand-worked rows."""

import pytest
from pyspark.sql import functions as F

from outcomelab.operators import decide, evaluate, score

LABELS = [0, 0, 1, 1, 0, 1]
SCORES = [.1, .1, .4, .35, .8, .9]


def frame(spark, labels=LABELS, scores=SCORES):
    return spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(zip(labels, scores))],
                                 "id long, y int, s double")


def test_strict_threshold(spark):
    df = score.add_prediction(frame(spark, [0, 1, 1], [.5, .51, None]), "s", 0.5)
    assert [r["pred"] for r in df.orderBy("id").collect()] == [0, 1, 0]


def test_ensembles(spark):
    df = spark.createDataFrame([(.9, .2), (.6, .7), (.2, .3)], "a double, b double")
    soft = score.ensemble(df, ["a", "b"]).collect()
    assert [r["pred"] for r in soft] == [1, 1, 0]
    assert soft[0]["score"] == pytest.approx(.55)
    hard = score.ensemble(df, ["a", "b"], method="voting").collect()
    assert [r["pred"] for r in hard] == [0, 1, 0]          # an even vote is negative
    weighted = score.ensemble(df, ["a", "b"], [3, 1], "voting").collect()
    assert [r["pred"] for r in weighted] == [1, 1, 0]
    with pytest.raises(ValueError, match="method"):
        score.ensemble(df, ["a", "b"], method="stacking")
    with pytest.raises(ValueError, match="weight"):
        score.ensemble(df, ["a", "b"], [1.0])


def test_auc_with_ties_and_one_class(spark):
    assert evaluate.roc_auc(frame(spark), "y", "s").first()["auc"] == pytest.approx(7 / 9)
    only = frame(spark, [1, 1], [.2, .3])
    assert evaluate.roc_auc(only, "y", "s").first()["auc"] is None


def test_roc_points_area_equals_auc(spark):
    points = sorted((r["fpr"], r["tpr"]) for r in
                    evaluate.roc_points(frame(spark), "y", "s").collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert points[0] == (0, 0) and points[-1] == (1, 1)
    assert area == pytest.approx(7 / 9)


def test_metrics_without_predicted_positives(spark):
    df = score.add_prediction(frame(spark), "s", 0.95)
    got = {r["metric"]: r["value"] for r in evaluate.metrics(df, "y", "pred").collect()}
    assert got == {"accuracy": .5, "precision": 0, "recall": 0, "f1": 0}
    cells = evaluate.confusion(df, "y", "pred")
    assert cells.count() == 4 and cells.agg(F.sum("n")).first()[0] == 6


def test_classification_report(spark):
    df = score.add_prediction(frame(spark), "s", 0.5)     # pred 0 0 0 0 1 1
    got = {r["name"]: r for r in
           evaluate.classification_report(df, "y", "pred", ("no", "yes")).collect()}
    assert got["yes"]["precision"] == .5 and got["yes"]["recall"] == pytest.approx(1 / 3)
    assert got["no"]["precision"] == .5 and got["no"]["support"] == 3
    assert got["accuracy"]["f1"] == .5 and got["macro avg"]["support"] == 6


def test_calibration_edges_belong_to_the_lower_bin(spark):
    df = frame(spark, [0, 1, 1, 0], [0.0, 0.1, 0.11, 1.0])
    got = {r["bin"]: (r["n"], r["positive_share"])
           for r in evaluate.calibration(df, "y", "s").collect()}
    assert got == {1: (2, .5), 2: (1, 1.0), 10: (1, 0.0)}


def test_compare_models_fills_absent_metrics(spark):
    a = spark.createDataFrame([("f1", .4), ("recall", .2)], "metric string, value double")
    b = spark.createDataFrame([("f1", .5)], "metric string, value double")
    got = {r["metric"]: (r["a"], r["b"]) for r in evaluate.compare_models({"a": a, "b": b}).collect()}
    assert got == {"accuracy": (0, 0), "precision": (0, 0), "recall": (.2, 0), "f1": (.4, .5)}


def test_threshold_scenario_and_recommendation(spark):
    df = frame(spark)
    table = decide.threshold_table(df, "y", "s")
    got = {r["threshold"]: (r["predicted"], r["correct"]) for r in table.collect()}
    assert got == {.3: (4, 3), .5: (2, 1), .7: (2, 1), .9: (0, 0)}
    best = {r["objective"]: r["threshold"] for r in decide.recommended_thresholds(table).collect()}
    assert best == {"precision": .3, "recall": .3, "f1": .3}
    scenario = {r["scenario"]: r for r in decide.scenario_table(df, "y", "s").collect()}
    assert scenario["balanced"]["waste_share"] == .5 and scenario["aggressive"]["missed"] == 0
    none = decide.scenario_table(frame(spark, [0, 1], [.1, .1]), "y", "s")
    assert {r["waste_share"] for r in none.collect()} == {None}


def test_first_threshold_wins_ties(spark):
    table = decide.threshold_table(frame(spark), "y", "s", (.5, .7))
    assert decide.best_row(table, "f1").first()["threshold"] == .5
    best = {r["objective"]: r["threshold"] for r in decide.recommended_thresholds(table).collect()}
    assert set(best.values()) == {.5}


def test_net_benefit_charges_beyond_the_table(spark):
    out = decide.net_benefit(frame(spark), "y", "s", "id", invites=(1, 3, 50))
    got = {r["invites"]: (r["tp"], r["fp"], r["net"]) for r in out.collect()}
    assert got == {1: (1, 0, 490_000), 3: (2, 1, 970_000), 50: (3, 47, 1_000_000)}
