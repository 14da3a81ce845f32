"""Parsing, flags and the derivation recipe on hand-worked rows."""

import math

import pytest
from pyspark.sql import functions as F

from outcomelab.functions import expr as E
from outcomelab.functions.height import add_height, height_inches, height_report
from outcomelab.operators import derive as D
from outcomelab.operators import shape
from outcomelab.plans import recipes as R

HEIGHTS = [
    ("6-Jun", 78, 78), ("2-Jun", 74, 30), ("Jun-02", 74, None), ("Jun-00", 72, None),
    ("2/Jun", 74, None), ("2-june", 74, 24), ("6-10", None, 72), ("7-00", None, 84),
    ("6", 72, None), ("78", 78, None), ("9", None, None), ("-", None, None), ("", None, None),
    (None, None, None), (" 2-Jun ", 74, 24), ("0006", 72, None), ("49", None, None),
    ("110", 110, None), ("111", None, None), ("2-Ju", None, 24), ("Jun5", None, None),
    ("2-xyz", None, 24), ("5-5-5", None, None), ("a-b", None, None), ("12-Dec", 156, 156),
]


def column(df, name):
    return [r[name] for r in df.collect()]


def test_height_modes(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _, _) in enumerate(HEIGHTS)],
                               "i int, ht string").orderBy("i")
    assert column(df.select(height_inches("ht").alias("h")), "h") == [m for _, m, _ in HEIGHTS]
    first = df.select(height_inches("ht", "feet_first").alias("h"))
    assert column(first, "h") == [f for _, _, f in HEIGHTS]


def test_height_plain_form_and_unknown_mode(spark):
    df = spark.createDataFrame([("6-10",), ("6-12",), ("7-00",), ("2-Jun",)], "ht string")
    assert column(df.select(height_inches("ht", plain=True).alias("h")), "h") == \
        [82, None, 84, 74]
    with pytest.raises(ValueError, match="mode"):
        height_inches("ht", "metric")


def test_add_height_numeric_source_and_report(spark):
    df = spark.createDataFrame([(70.0,), (math.nan,), (None,)], "ht double")
    out = add_height(df)
    assert column(out, "height_numeric") == [70.0, None, None]
    assert height_report(out).first().asDict() == {
        "n": 3, "missing": 2, "missing_share": pytest.approx(2 / 3)}
    assert add_height(spark.range(1)).columns == ["id"]


def test_missing_values_in_expressions(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (math.nan, 1.0)], "a double, b double")
    out = df.select(E.number("a").alias("n"), E.flag(F.col("a") > 0.5).alias("f"),
                    E.guarded_ratio("a", "b", 0.0).alias("r"),
                    E.weighted_sum({"a": 2, "b": 1}).alias("w")).collect()
    assert [r["n"] for r in out] == [1.0, None, None]
    assert [r["f"] for r in out][:2] == [1, 0]
    assert out[0]["r"] is None                      # zero denominator
    assert out[0]["w"] == 2.0 and out[1]["w"] is None


def test_number_parsing_ordinal_and_category(spark):
    df = spark.createDataFrame([("2019", "Fr"), ("n/a", "Gr"), (None, None)], "y string, c string")
    out = df.select(E.parse_number("y").alias("y"), E.ordinal("c", R.CLASS_YEARS).alias("o"),
                    E.filled_category("c").alias("c")).collect()
    assert [tuple(r) for r in out] == [(2019.0, 1.0, "Fr"), (None, None, "Gr"),
                                       (None, None, "missing")]


PLAYER = {
    "type": "Combo G", "conf": "ACC", "eFG": 50.0, "ast_tov": 2.0, "TS_per": 60.0, "pts": 20.0,
    "treb": 5.0, "ast": 4.0, "stl": 1.0, "blk": 1.0, "TP_per": 40.0, "mp": 40.0, "bpm": 6.0,
    "GP": 30.0, "usg": 25.0, "Min_per": 80.0, "AST_per": 25.0, "TO_per": 10.0, "stl_per": 2.0,
    "blk_per": 3.0, "ORB_per": 4.0, "DRB_per": 16.0, "year": "2019", "height_numeric": 82.0,
    "Rec_Rank": None,
}


def test_recipe_values(spark):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}"
                       for k, v in PLAYER.items())
    df = spark.createDataFrame([tuple(PLAYER.values())], schema)
    row = D.apply_recipe(df, R.PLAYER_SEASON).first().asDict()
    expected = {
        "efficiency_score": 50 * .4 + 2 * .3 + 60 * .3, "all_around_score": 6 + 1 + 1 + .15 + .1,
        "versatile_guard": 0, "stretch_big": 0, "defensive_specialist": 0, "power_conference": 1,
        "pts_per_min": .5, "reb_per_min": .125, "ast_pts_ratio": .2, "defensive_rating": 2,
        "advanced_metric": 6, "simple_efficiency": 31 / 30, "true_shooting": 60,
        "usage_efficiency": 1500, "minutes_impact": 480, "offensive_load": 50,
        "assist_turnover_ratio": 2, "defensive_stats": 5, "rebound_total": 20,
        "all_around_score_v2": 25 * .3 + 20 * .4 + 5 * .3,
        "true_shooting_volume": 60 * math.log(26), "per_minute_impact": 6 / 81,
        "year_numeric": 2019, "big_man_shooter": 1, "playmaking_big": 1, "has_recruit_rank": 0,
    }
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, rel=1e-6), name


def test_recipe_skips_missing_inputs_and_uses_fallbacks(spark):
    df = spark.createDataFrame([(50.0, 60.0, 20.0, 10.0)],
                               "eFG double, TS_per double, AST_per double, TO_per double")
    out = D.apply_recipe(df, R.PLAYER_SEASON)
    row = out.first()
    assert row["efficiency_score"] == 55.0
    assert row["assist_turnover_ratio"] == pytest.approx(20 / 10.1)
    assert "all_around_score" not in out.columns and "big_man_shooter" not in out.columns


def test_thresholds_come_from_the_fitting_table(spark):
    recipe = [D.all_above("high", quantile={"x": 0.5})]
    train = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    other = spark.createDataFrame([(2.0,), (2.5,), (None,)], "x double")
    limits = D.fit_thresholds(train, recipe)
    assert limits == {"x@0.5": 2.0}
    assert column(D.apply_recipe(other, recipe, limits), "high") == [0, 1, 0]


def test_flag_with_nothing_to_fit_is_zero(spark):
    recipe = [D.any_above("high", {"x": 0.8})]
    df = spark.createDataFrame([(None,)], "x double")
    assert column(D.apply_recipe(df, recipe), "high") == [0]


def test_recipe_is_one_projection(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0)],
                               "AST_per double, ORB_per double, DRB_per double, "
                               "stl_per double, blk_per double")
    out = D.apply_recipe(df, R.IMPACT)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_shape_rules(spark):
    df = spark.createDataFrame([("p1", "duke", 3, 1.0, 1), ("p2", "unc", None, 2.0, 0)],
                               "player_id string, team string, pick int, x double, drafted int")
    assert shape.select_features(df, "drafted").columns == ["x"]
    assert shape.select_features(df, exclude=["x"]).columns == []
    assert shape.split_features_target(df, "drafted").columns == \
        ["player_id", "team", "x", "drafted"]
    assert column(shape.define_target(df.drop("drafted")), "drafted") == [1, 0]
    untouched = df.drop("drafted", "pick")
    assert shape.define_target(untouched).columns == untouched.columns
    with pytest.raises(ValueError, match="a, b"):
        shape.require_columns(df, ["a", "b"])
    assert dict(shape.promote_numeric(df, ["drafted"]).dtypes)["pick"] == "double"


def test_points_sample_only_on_request(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("y"),
                                  F.col("id").cast("double").alias("a"),
                                  F.col("id").cast("double").alias("b"))
    assert shape.points(df, "y", "a", "b").count() == 1000
    sampled = shape.points(df, "y", "a", "b", fractions={0: 0.1, 1: 0.5}, seed=1)
    assert 150 < sampled.count() < 450
