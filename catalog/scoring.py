"""J: scoring, evaluation, decisions, on the cohort's given score columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelab.operators import decide, evaluate, score
from outcomelab.plans.order_cohort import order_cohort

from .cohorts import histogram_sql
from .registry import check, rounded
from .sql import on_cohort


def scored(spark, sf, threshold=0.5, column="score"):
    c = order_cohort(spark, sf).select("id", "label", "score", "score_b", "score_c")
    return score.add_prediction(c, column, threshold)


@check("J1_score_and_threshold", on_cohort("""
SELECT id, score, CASE WHEN score > 0.6::DOUBLE THEN 1 ELSE 0 END AS pred FROM cohort"""))
def _(spark, sf):
    return scored(spark, sf, 0.6).select("id", "score", "pred")


SCORES = ["score", "score_b", "score_c"]


@check("J3_soft_ensemble", on_cohort("""
SELECT id, round((score * 0.5::DOUBLE + score_b * 0.3::DOUBLE + score_c * 0.2::DOUBLE), 6)
       AS score_mean,
       CASE WHEN (score * 0.5::DOUBLE + score_b * 0.3::DOUBLE + score_c * 0.2::DOUBLE)
            / (0.5::DOUBLE + 0.3::DOUBLE + 0.2::DOUBLE) > 0.5 THEN 1 ELSE 0 END AS pred
FROM cohort"""))
def _(spark, sf):
    c = order_cohort(spark, sf)
    out = score.ensemble(c, SCORES, [0.5, 0.3, 0.2], score="score_mean")
    return rounded(out.select("id", "score_mean", "pred"), "score_mean")


@check("J3_hard_ensemble", on_cohort("""
SELECT id, round((score + score_b) / 2, 6) AS score_mean,
       CASE WHEN score > 0.5 AND score_b > 0.5 THEN 1 ELSE 0 END AS pred FROM cohort"""))
def _(spark, sf):
    out = score.ensemble(order_cohort(spark, sf), ["score", "score_b"], method="voting",
                         score="score_mean")
    return rounded(out.select("id", "score_mean", "pred"), "score_mean")


CELLS = """
, p AS (SELECT label, CASE WHEN {s} > 0.5 THEN 1 ELSE 0 END AS pred FROM cohort),
k AS (SELECT count(CASE WHEN label = 0 AND pred = 0 THEN 1 END)::DOUBLE AS tn,
             count(CASE WHEN label = 0 AND pred = 1 THEN 1 END)::DOUBLE AS fp,
             count(CASE WHEN label = 1 AND pred = 0 THEN 1 END)::DOUBLE AS fn,
             count(CASE WHEN label = 1 AND pred = 1 THEN 1 END)::DOUBLE AS tp FROM p),
m AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS acc, coalesce(tp / nullif(tp + fp, 0), 0) AS pr,
             coalesce(tp / nullif(tp + fn, 0), 0) AS re, coalesce(tn / nullif(tn + fn, 0), 0) AS pr0,
             coalesce(tn / nullif(tn + fp, 0), 0) AS re0 FROM k),
f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1,
             coalesce(2 * pr0 * re0 / nullif(pr0 + re0, 0), 0) AS f0,
             tn + fp AS n0, fn + tp AS n1, tn + fp + fn + tp AS n FROM m)"""


@check("J4_confusion", on_cohort(CELLS.format(s="score") + """
SELECT 0 AS label, 0 AS pred, CAST(tn AS BIGINT) AS n, round(tn / n, 6) AS share_total,
       round(tn / n0, 6) AS share_row FROM f
UNION ALL SELECT 0, 1, CAST(fp AS BIGINT), round(fp / n, 6), round(fp / n0, 6) FROM f
UNION ALL SELECT 1, 0, CAST(fn AS BIGINT), round(fn / n, 6), round(fn / n1, 6) FROM f
UNION ALL SELECT 1, 1, CAST(tp AS BIGINT), round(tp / n, 6), round(tp / n1, 6) FROM f"""))
def _(spark, sf):
    return rounded(evaluate.confusion(scored(spark, sf), "label", "pred"),
                   "share_total", "share_row")


AUC = """
SELECT (sum(CASE WHEN label = 1 THEN r ELSE 0 END) - sum(label)::DOUBLE * (sum(label) + 1) / 2)
       / (sum(label)::DOUBLE * (count(*) - sum(label)))
FROM (SELECT label, rank() OVER (ORDER BY {s})
             + (count(*) OVER (PARTITION BY {s}) - 1) / 2.0::DOUBLE AS r FROM cohort)"""


@check("J5_roc_auc", on_cohort(f"SELECT round(({AUC.format(s='score')}), 6) AS auc"))
def _(spark, sf):
    return rounded(evaluate.roc_auc(scored(spark, sf), "label", "score"), "auc")


@check("J6_metrics", on_cohort(CELLS.format(s="score") + f"""
SELECT 'accuracy' AS metric, round(acc, 6) AS value FROM f
UNION ALL SELECT 'precision', round(pr, 6) FROM f UNION ALL SELECT 'recall', round(re, 6) FROM f
UNION ALL SELECT 'f1', round(f1, 6) FROM f
UNION ALL SELECT 'roc_auc', round(({AUC.format(s='score')}), 6)"""))
def _(spark, sf):
    return rounded(evaluate.metrics(scored(spark, sf), "label", "pred", "score"), "value")


@check("J7_classification_report", on_cohort(CELLS.format(s="score") + """
SELECT 'no' AS name, round(pr0, 6) AS precision, round(re0, 6) AS recall, round(f0, 6) AS f1,
       CAST(n0 AS BIGINT) AS support FROM f
UNION ALL SELECT 'yes', round(pr, 6), round(re, 6), round(f1, 6), CAST(n1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((pr + pr0) / 2, 6), round((re + re0) / 2, 6),
                 round((f1 + f0) / 2, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round((pr * n1 + pr0 * n0) / n, 6),
                 round((re * n1 + re0 * n0) / n, 6), round((f1 * n1 + f0 * n0) / n, 6),
                 CAST(n AS BIGINT) FROM f"""))
def _(spark, sf):
    out = evaluate.classification_report(scored(spark, sf), "label", "pred", ("no", "yes"))
    return rounded(out, "precision", "recall", "f1")


@check("J8_roc_points", on_cohort("""
, g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM cohort GROUP BY score)
SELECT score AS threshold,
  round(sum(n) OVER (ORDER BY score DESC)::DOUBLE / sum(n) OVER (), 6) AS fpr,
  round(sum(p) OVER (ORDER BY score DESC)::DOUBLE / sum(p) OVER (), 6) AS tpr FROM g"""))
def _(spark, sf):
    points = evaluate.roc_points(scored(spark, sf), "label", "score")
    return rounded(points.where(F.col("threshold") != float("inf")), "fpr", "tpr")


@check("J9_calibration", on_cohort("""
SELECT CAST(1 + list_sum(list_transform(range(1, 10), lambda i: CAST(score > i * 0.1::DOUBLE AS INTEGER)))
            AS INTEGER) AS bin, count(*) AS n, round(avg(score), 6) AS mean_score,
       round(avg(label), 6) AS positive_share FROM cohort GROUP BY 1"""))
def _(spark, sf):
    return rounded(evaluate.calibration(scored(spark, sf), "label", "score"),
                   "mean_score", "positive_share")


@check("J10_score_histogram", histogram_sql("score", 50))
def _(spark, sf):
    return rounded(evaluate.score_histogram(scored(spark, sf), "label", "score"),
                   "lo", "hi", "density")


def at_thresholds(values):
    rows = ", ".join(f"({i}, {t}::DOUBLE)" for i, t in enumerate(values))
    return f"""
, t AS (SELECT CAST(i AS INTEGER) AS pos, x FROM (VALUES {rows}) v(i, x)),
m AS (SELECT pos, x, count(CASE WHEN score > x THEN 1 END) AS p,
             count(CASE WHEN score > x AND label = 1 THEN 1 END) AS c,
             CAST(sum(label) AS BIGINT) AS y, count(*) AS n FROM t, cohort GROUP BY pos, x),
f AS (SELECT *, coalesce(c::DOUBLE / nullif(p, 0), 0) AS pr, coalesce(c::DOUBLE / nullif(y, 0), 0) AS re
      FROM m),
g AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM f)"""


@check("J11_threshold_table", on_cohort(at_thresholds(decide.THRESHOLDS) + """
SELECT pos, x AS threshold, p AS predicted, c AS correct, round(pr, 6) AS precision,
       round(re, 6) AS recall, round(f1, 6) AS f1, n AS total, y AS positives,
       round(y::DOUBLE / n, 6) AS rate FROM g"""))
def _(spark, sf):
    return rounded(decide.threshold_table(scored(spark, sf), "label", "score"),
                   "precision", "recall", "f1", "rate")


@check("J12_scenarios", on_cohort(at_thresholds(decide.SCENARIOS.values()) + """
SELECT ['conservative', 'balanced', 'aggressive'][pos + 1] AS scenario, x AS threshold,
       p AS selected, c AS hits, round(c::DOUBLE / y, 6) AS hit_share, p - c AS wasted,
       round((p - c)::DOUBLE / nullif(p, 0), 6) AS waste_share, y - c AS missed FROM g"""))
def _(spark, sf):
    return rounded(decide.scenario_table(scored(spark, sf), "label", "score"),
                   "hit_share", "waste_share")


@check("J13_recommended_thresholds", on_cohort(at_thresholds(decide.THRESHOLDS) + """
SELECT * FROM (SELECT 'precision' AS objective, x AS threshold, round(pr, 6) AS value FROM g
               ORDER BY pr DESC, pos LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'recall', x, round(re, 6) FROM g ORDER BY re DESC, pos LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'f1', x, round(f1, 6) FROM g ORDER BY f1 DESC, pos LIMIT 1)"""))
def _(spark, sf):
    t = decide.threshold_table(scored(spark, sf), "label", "score")
    return rounded(decide.recommended_thresholds(t), "value")


@check("J14_net_benefit", on_cohort("""
, r AS (SELECT label, row_number() OVER (ORDER BY score DESC, id) AS r FROM cohort)
SELECT CAST(n AS INTEGER) AS invites, count(CASE WHEN label = 1 AND r <= n THEN 1 END) AS tp,
       n - count(CASE WHEN label = 1 AND r <= n THEN 1 END) AS fp,
       count(CASE WHEN label = 1 AND r <= n THEN 1 END) * 500000.0::DOUBLE - n * 10000.0::DOUBLE AS net
FROM r, range(50, 551, 50) t(n) GROUP BY n"""))
def _(spark, sf):
    return decide.net_benefit(scored(spark, sf), "label", "score", "id")


def metric_sql(s):
    return on_cohort(CELLS.format(s=s) + """
SELECT 'accuracy' AS metric, acc AS v FROM f UNION ALL SELECT 'precision', pr FROM f
UNION ALL SELECT 'recall', re FROM f UNION ALL SELECT 'f1', f1 FROM f""")


@check("J15_model_comparison", f"""
SELECT metric, round(a.v, 6) AS base, round(b.v, 6) AS second, round(c.v, 6) AS third
FROM ({metric_sql('score')}) a JOIN ({metric_sql('score_b')}) b USING (metric)
     JOIN ({metric_sql('score_c')}) c USING (metric)""")
def _(spark, sf):
    results = {name: evaluate.metrics(scored(spark, sf, 0.5, s), "label", "pred")
               for name, s in zip(("base", "second", "third"), SCORES)}
    return rounded(evaluate.compare_models(results), "base", "second", "third")
