"""The player-season recipe: fixed formulas, fed to the generic steps."""

from __future__ import annotations

from ..operators.derive import (
    all_above, any_above, blend, copy, level, log_volume, member, presence, product, ratio,
    to_number, total,
)

# Fixed values.
CLASS_YEARS = {"Fr": 1, "So": 2, "Jr": 3, "Sr": 4}
GUARD_TYPES = ("PG", "SG", "G", "Combo G", "Pure PG", "Scoring PG")
BIG_TYPES = ("PF", "C", "F-C", "C-F", "Stretch 4", "Stretch 5")
POWER_CONFERENCES = ("B10", "B12", "ACC", "SEC", "P12", "BE")
TINY = 1e-6

CLASS_YEAR = [level("yr_numeric", "yr", CLASS_YEARS)]

EFFICIENCY = [
    blend("efficiency_score", eFG=0.4, ast_tov=0.3, TS_per=0.3),
    blend("efficiency_score", eFG=0.5, TS_per=0.5),
]
ALL_AROUND = [blend("all_around_score", pts=0.3, treb=0.2, ast=0.25, stl=0.15, blk=0.1)]
RARE_SKILLS = [
    all_above("versatile_guard", ("type", GUARD_TYPES), {"ast": 0.7, "treb": 0.7}),
    all_above("stretch_big", ("type", BIG_TYPES), TP_per=0.35),
    any_above("defensive_specialist", {"stl": 0.8, "blk": 0.8}),
]
POWER_CONFERENCE = [member("power_conference", "conf", POWER_CONFERENCES)]
INTERACTIONS = [
    ratio("pts_per_min", "pts", "mp", TINY),
    ratio("reb_per_min", "treb", "mp", TINY),
    ratio("ast_pts_ratio", "ast", "pts", TINY),
    total("defensive_rating", "blk", "stl"),
]
ADVANCED = [
    copy("advanced_metric", "bpm"),
    total("stat_total", "pts", "treb", "ast", "stl", "blk"),
    ratio("simple_efficiency", "stat_total", "GP", TINY),
    copy("simple_efficiency", "stat_total"),
    copy("true_shooting", "TS_per"),
]
IMPACT = [
    product("usage_efficiency", "usg", "TS_per"),
    product("minutes_impact", "Min_per", "bpm"),
    total("offensive_load", "usg", "AST_per"),
    copy("assist_turnover_ratio", "ast_tov"),
    ratio("assist_turnover_ratio", "AST_per", "TO_per", 0.1),
    total("defensive_stats", "stl_per", "blk_per"),
    total("rebound_total", "ORB_per", "DRB_per"),
    blend("all_around_score_v2", AST_per=0.3, rebound_total=0.4, defensive_stats=0.3),
    log_volume("true_shooting_volume", "TS_per", "usg"),
    ratio("per_minute_impact", "bpm", "Min_per", 1.0),
    to_number("year_numeric", "year"),
]
BIG_MEN = [
    all_above("big_man_shooter", height_numeric=80, TP_per=35),
    all_above("big_man_shooter", height_inches=80, TP_per=35),
    all_above("playmaking_big", height_numeric=80, AST_per=20),
    all_above("playmaking_big", height_inches=80, AST_per=20),
    presence("has_recruit_rank", "Rec_Rank"),
]

# Helper columns that the recipe builds but does not keep.
SCRATCH = ("stat_total",)

PLAYER_SEASON = [
    *EFFICIENCY, *ALL_AROUND, *RARE_SKILLS, *POWER_CONFERENCE, *INTERACTIONS, *ADVANCED,
    *IMPACT, *BIG_MEN,
]
