"""D: scalar functions and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelab.functions.expr import filled_category
from outcomelab.functions.height import add_height, height_inches, height_report
from outcomelab.operators.cohort import group_rate
from outcomelab.operators.derive import apply_recipe, fit_thresholds
from outcomelab.operators.profile import value_counts
from outcomelab.plans import recipes as R
from outcomelab.plans.order_cohort import height_table, order_cohort, season_table

from .registry import check, rounded
from .sql import on_cohort, on_heights, on_season

MONTHS = " ".join(
    f"WHEN '{m}' THEN {i}" for i, m in enumerate(
        ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1))
MONTHS_CASED = " ".join(
    f"WHEN '{m}' THEN {i}" for i, m in enumerate(
        ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"), 1))

FEET_FIRST = rf"""
CASE WHEN ht IS NULL OR ht = '-' THEN NULL
  WHEN len(string_split(ht, '-')) = 2 AND regexp_matches(string_split(ht, '-')[1], '^\s*\d+\s*$')
  THEN CAST(CAST(trim(string_split(ht, '-')[1]) AS INTEGER) * 12
       + CASE string_split(ht, '-')[2] {MONTHS_CASED} ELSE 0 END AS DOUBLE) END"""

MONTH_IS_FEET = rf"""
CASE
  WHEN regexp_matches(trim(ht), '^\d{{1,2}}[-/]\D+$') THEN CAST(12 *
    CASE lower(substr(regexp_extract(trim(ht), '^\d{{1,2}}[-/](\D+)$', 1), 1, 3)) {MONTHS} END
    + CAST(regexp_extract(trim(ht), '^(\d{{1,2}})', 1) AS INTEGER) AS DOUBLE)
  WHEN regexp_matches(trim(ht), '^\D+[-/]\d{{1,2}}$') THEN CAST(12 *
    CASE lower(substr(trim(ht), 1, 3)) {MONTHS} END
    + CAST(regexp_extract(trim(ht), '(\d{{1,2}})$', 1) AS INTEGER) AS DOUBLE)
  WHEN regexp_matches(trim(ht), '^\d+$') THEN CAST(
    CASE WHEN CAST(trim(ht) AS INTEGER) BETWEEN 4 AND 8 THEN CAST(trim(ht) AS INTEGER) * 12
         WHEN CAST(trim(ht) AS INTEGER) BETWEEN 50 AND 110 THEN CAST(trim(ht) AS INTEGER) END
    AS DOUBLE) END"""


@check("D1_height_feet_first", on_heights(f"""
SELECT id, {FEET_FIRST} AS height_inches, {FEET_FIRST} AS height_numeric FROM heights"""))
def _(spark, sf):
    return add_height(height_table(spark, sf), mode="feet_first").select(
        "id", "height_inches", "height_numeric")


@check("D1_height_report", on_heights(f"""
SELECT count(*) AS n, count(*) - count(h) AS missing,
       round((count(*) - count(h))::DOUBLE / count(*), 6) AS missing_share
FROM (SELECT {FEET_FIRST} AS h FROM heights)"""))
def _(spark, sf):
    return rounded(height_report(add_height(height_table(spark, sf), mode="feet_first")),
                   "missing_share")


@check("D2_height_month_is_feet", on_heights(
    f"SELECT id, {MONTH_IS_FEET} AS height_inches FROM heights"))
def _(spark, sf):
    return height_table(spark, sf).select("id", height_inches("ht").alias("height_inches"))


@check("D2_height_plain", on_heights(rf"""
SELECT id, CASE WHEN regexp_matches(ht, '^\s*\d-\d{{1,2}}\s*$')
                 AND CAST(string_split(trim(ht), '-')[2] AS INTEGER) < 12
            THEN CAST(string_split(trim(ht), '-')[1] AS INTEGER) * 12.0::DOUBLE
                 + CAST(string_split(trim(ht), '-')[2] AS INTEGER)
            ELSE {MONTH_IS_FEET} END AS height_inches FROM heights"""))
def _(spark, sf):
    return height_table(spark, sf).select(
        "id", height_inches("ht", plain=True).alias("height_inches"))


@check("D3_class_year", on_season("""
SELECT player_id, CASE yr WHEN 'Fr' THEN 1.0::DOUBLE WHEN 'So' THEN 2 WHEN 'Jr' THEN 3
       WHEN 'Sr' THEN 4 END AS yr_numeric FROM season"""))
def _(spark, sf):
    return apply_recipe(season_table(spark, sf), R.CLASS_YEAR).select("player_id", "yr_numeric")


@check("D3_class_year_counts", on_season("SELECT yr, count(*) AS n FROM season GROUP BY yr"))
def _(spark, sf):
    return value_counts(season_table(spark, sf), "yr", order="key")


@check("D3_rate_by_class_year", on_season("""
SELECT yr, CAST(sum(drafted) AS BIGINT) AS positives, count(*) AS n,
       round(avg(drafted), 6) AS rate FROM season GROUP BY yr"""))
def _(spark, sf):
    return rounded(group_rate(season_table(spark, sf), "yr", "drafted"), "rate")


def recipe_check(name, recipe, columns, sql):
    """Register one recipe group; ``sql`` gives the expression of each output column."""
    body = ", ".join(f"{e} AS {c}" for c, e in zip(columns, sql))
    floats = [c for c, e in zip(columns, sql) if e.startswith("round(")]

    @check(name, on_season(f"SELECT player_id, {body} FROM season"))
    def _(spark, sf):
        derived = apply_recipe(season_table(spark, sf), recipe)
        return rounded(derived.select("player_id", *columns), *floats)


recipe_check("D4_efficiency_score", R.EFFICIENCY, ["efficiency_score"],
             ['round("eFG" * 0.4 + ast_tov * 0.3 + "TS_per" * 0.3, 6)'])
recipe_check("D5_all_around_score", R.ALL_AROUND, ["all_around_score"],
             ["round(pts * 0.3 + treb * 0.2 + ast * 0.25 + stl * 0.15 + blk * 0.1, 6)"])
recipe_check("D7_stretch_big", R.RARE_SKILLS, ["stretch_big"], ["""
  CASE WHEN type IN ('PF','C','F-C','C-F','Stretch 4','Stretch 5') AND "TP_per" > 0.35
  THEN 1 ELSE 0 END"""])
recipe_check("D9_power_conference", R.POWER_CONFERENCE, ["power_conference"],
             ["CASE WHEN conf IN ('B10','B12','ACC','SEC','P12','BE') THEN 1 ELSE 0 END"])
recipe_check("D10_interactions", R.INTERACTIONS,
             ["pts_per_min", "reb_per_min", "ast_pts_ratio", "defensive_rating"],
             ["round(pts / (mp + 1e-6), 6)", "round(treb / (mp + 1e-6), 6)",
              "round(ast / (pts + 1e-6), 6)", "round(blk + stl, 6)"])
recipe_check("D11_advanced_metrics", R.ADVANCED,
             ["advanced_metric", "simple_efficiency", "true_shooting"],
             ["round(bpm, 6)", 'round((pts + treb + ast + stl + blk) / ("GP" + 1e-6), 6)',
              'round("TS_per", 6)'])
recipe_check("D12_products_and_sums", R.IMPACT,
             ["usage_efficiency", "minutes_impact", "offensive_load", "defensive_stats",
              "rebound_total"],
             ['round(usg * "TS_per", 6)', 'round("Min_per" * bpm, 6)', 'round(usg + "AST_per", 6)',
              "round(stl_per + blk_per, 6)", 'round("ORB_per" + "DRB_per", 6)'])
recipe_check("D13_assist_turnover", R.IMPACT, ["assist_turnover_ratio"], ["round(ast_tov, 6)"])
recipe_check("D14_all_around_v2", R.IMPACT, ["all_around_score_v2"], [
    'round("AST_per" * 0.3 + ("ORB_per" + "DRB_per") * 0.4 + (stl_per + blk_per) * 0.3, 6)'])
recipe_check("D15_log_volume_and_impact", R.IMPACT, ["true_shooting_volume", "per_minute_impact"],
             ['round("TS_per" * ln(1 + usg), 6)', 'round(bpm / ("Min_per" + 1), 6)'])
recipe_check("D16_year_numeric", R.IMPACT, ["year_numeric"], ["TRY_CAST(year AS DOUBLE)"])
recipe_check("D17_big_men", R.BIG_MEN, ["big_man_shooter", "playmaking_big"], [
    'CASE WHEN height_numeric > 80 AND "TP_per" > 35 THEN 1 ELSE 0 END',
    'CASE WHEN height_numeric > 80 AND "AST_per" > 20 THEN 1 ELSE 0 END'])
recipe_check("D18_recruit_presence", R.BIG_MEN, ["has_recruit_rank"],
             ['CASE WHEN "Rec_Rank" IS NOT NULL THEN 1 ELSE 0 END'])


@check("D4_efficiency_fallback", on_season("""
SELECT player_id, round("eFG" * 0.5 + "TS_per" * 0.5, 6) AS efficiency_score FROM season"""))
def _(spark, sf):
    derived = apply_recipe(season_table(spark, sf).drop("ast_tov"), R.EFFICIENCY)
    return rounded(derived.select("player_id", "efficiency_score"), "efficiency_score")


@check("D13_assist_turnover_fallback", on_season("""
SELECT player_id, round("AST_per" / ("TO_per" + 0.1), 6) AS assist_turnover_ratio FROM season"""))
def _(spark, sf):
    derived = apply_recipe(season_table(spark, sf).drop("ast_tov"), R.IMPACT)
    return rounded(derived.select("player_id", "assist_turnover_ratio"), "assist_turnover_ratio")


GUARDS = "('PG','SG','G','Combo G','Pure PG','Scoring PG')"


@check("D6_versatile_guard", on_season(f"""
, lim AS (SELECT quantile_cont(ast, 0.7) AS a, quantile_cont(treb, 0.7) AS t FROM season)
SELECT player_id, CASE WHEN type IN {GUARDS} AND ast > a AND treb > t THEN 1 ELSE 0 END
       AS versatile_guard FROM season, lim"""))
def _(spark, sf):
    return apply_recipe(season_table(spark, sf), R.RARE_SKILLS).select(
        "player_id", "versatile_guard")


@check("D6_versatile_guard_train_limits", on_season(f"""
, lim AS (SELECT quantile_cont(ast, 0.7) AS a, quantile_cont(treb, 0.7) AS t
          FROM season WHERE drafted = 1)
SELECT player_id, CASE WHEN type IN {GUARDS} AND ast > a AND treb > t THEN 1 ELSE 0 END
       AS versatile_guard FROM season, lim"""))
def _(spark, sf):
    s = season_table(spark, sf)
    limits = fit_thresholds(s.where(F.col("drafted") == 1), R.RARE_SKILLS)
    return apply_recipe(s, R.RARE_SKILLS, limits).select("player_id", "versatile_guard")


@check("D8_defensive_specialist", on_season("""
, lim AS (SELECT quantile_cont(stl, 0.8) AS s, quantile_cont(blk, 0.8) AS b FROM season)
SELECT player_id, CASE WHEN stl > s OR blk > b THEN 1 ELSE 0 END AS defensive_specialist
FROM season, lim"""))
def _(spark, sf):
    return apply_recipe(season_table(spark, sf), R.RARE_SKILLS).select(
        "player_id", "defensive_specialist")


@check("D19_whole_recipe", on_season(f"""
, lim AS (SELECT quantile_cont(ast, 0.7) AS a, quantile_cont(treb, 0.7) AS t,
                 quantile_cont(stl, 0.8) AS s, quantile_cont(blk, 0.8) AS b FROM season)
SELECT player_id,
  round("eFG" * 0.4 + ast_tov * 0.3 + "TS_per" * 0.3, 6) AS efficiency_score,
  CASE WHEN type IN {GUARDS} AND ast > a AND treb > t THEN 1 ELSE 0 END AS versatile_guard,
  CASE WHEN stl > s OR blk > b THEN 1 ELSE 0 END AS defensive_specialist,
  CASE WHEN conf IN ('B10','B12','ACC','SEC','P12','BE') THEN 1 ELSE 0 END AS power_conference,
  round(pts / (mp + 1e-6), 6) AS pts_per_min,
  round((pts + treb + ast + stl + blk) / ("GP" + 1e-6), 6) AS simple_efficiency,
  round("AST_per" * 0.3 + ("ORB_per" + "DRB_per") * 0.4 + (stl_per + blk_per) * 0.3, 6)
    AS all_around_score_v2,
  CASE WHEN height_numeric > 80 AND "AST_per" > 20 THEN 1 ELSE 0 END AS playmaking_big
FROM season, lim"""))
def _(spark, sf):
    derived = apply_recipe(season_table(spark, sf), R.PLAYER_SEASON)
    return rounded(derived.select(
        "player_id", "efficiency_score", "versatile_guard", "defensive_specialist",
        "power_conference", "pts_per_min", "simple_efficiency", "all_around_score_v2",
        "playmaking_big"), "efficiency_score", "pts_per_min", "simple_efficiency",
        "all_around_score_v2")


@check("D20_missing_category", on_cohort("""
SELECT id, coalesce(CAST(returned AS VARCHAR), 'missing') AS returned_level,
       coalesce(CASE WHEN segment <> 'BUILDING' THEN segment END, 'missing') AS segment_level
FROM cohort"""))
def _(spark, sf):
    return order_cohort(spark, sf).select(
        "id", filled_category("returned").alias("returned_level"),
        filled_category(F.when(F.col("segment") != "BUILDING", F.col("segment")))
        .alias("segment_level"))
