"""G: running shares, top-k, global ranks, best row."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelab.operators.assoc import target_correlations
from outcomelab.operators.decide import best_row, threshold_table
from outcomelab.operators.model import features_to_reach, importance_shares
from outcomelab.operators.ordering import ranked_rows, top_rows
from outcomelab.plans.order_cohort import order_cohort

from .cohorts import STATS, correlations_sql
from .registry import check, rounded
from .sql import on_cohort

SHARES = f"""
, imp AS (SELECT feature, abs(r) AS importance FROM ({correlations_sql(STATS)})
          ORDER BY importance DESC, feature LIMIT 6),
shares AS (SELECT *, importance / sum(importance) OVER () * 100 AS share_pct FROM imp),
cum AS (SELECT *, sum(share_pct) OVER (ORDER BY importance DESC, feature
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pct FROM shares)"""


def importances(spark, sf):
    r = target_correlations(order_cohort(spark, sf), "label", STATS, top=None)
    return r.select("feature", F.col("abs_r").alias("importance"))


@check("G1_running_share", on_cohort(SHARES + """
SELECT feature, round(importance, 6) AS importance, round(share_pct, 4) AS share_pct,
       round(cum_pct, 4) AS cum_pct FROM cum"""))
def _(spark, sf):
    out = importance_shares(importances(spark, sf), 6)
    return out.select("feature", F.round("importance", 6).alias("importance"),
                      F.round("share_pct", 4).alias("share_pct"),
                      F.round("cum_pct", 4).alias("cum_pct"))


@check("G1_features_to_reach", on_cohort(
    SHARES + "SELECT count(CASE WHEN cum_pct < 80 THEN 1 END) + 1 AS n_features FROM cum"))
def _(spark, sf):
    return features_to_reach(importance_shares(importances(spark, sf), 6), 80)


@check("G2_top_k", on_cohort("SELECT id, price FROM cohort ORDER BY price DESC NULLS LAST, id LIMIT 25"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "price")
    return c.orderBy(F.desc_nulls_last("price"), "id").limit(25)


RANKED = """SELECT id, score, {r} AS rank FROM (
  SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS r FROM cohort)"""


@check("G3_top_by_score", on_cohort(
    RANKED.format(r="CAST(r AS INTEGER)") + " WHERE r <= 300"))
def _(spark, sf):
    return top_rows(order_cohort(spark, sf).select("id", "score"), "score", "id", 300)


@check("G3_rank_every_row", on_cohort(RANKED.format(r="r")))
def _(spark, sf):
    return ranked_rows(order_cohort(spark, sf).select("id", "score"), "score", "id")


@check("G4_best_threshold", on_cohort("""
, t AS (SELECT CAST(i - 1 AS INTEGER) AS pos, x FROM
        (VALUES (1, 0.3::DOUBLE), (2, 0.5::DOUBLE), (3, 0.7::DOUBLE), (4, 0.9::DOUBLE)) v(i, x)),
m AS (SELECT pos, x, count(CASE WHEN score > x THEN 1 END) AS p,
             count(CASE WHEN score > x AND label = 1 THEN 1 END) AS c, sum(label) AS y
      FROM t, cohort GROUP BY pos, x),
f AS (SELECT pos, x, coalesce(c::DOUBLE / nullif(p, 0), 0) AS pr,
             coalesce(c::DOUBLE / nullif(y, 0), 0) AS re FROM m)
SELECT x AS threshold, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1
FROM f ORDER BY f1 DESC, pos LIMIT 1"""))
def _(spark, sf):
    t = threshold_table(order_cohort(spark, sf), "label", "score")
    return rounded(best_row(t, "f1").select("threshold", "f1"), "f1")
