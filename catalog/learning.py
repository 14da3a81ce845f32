"""K1, K7, I4, I14, F21, J8: boosted trees, target statistics, neighbour information and exact tests."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from outcomelab.operators import boosting as B
from outcomelab.operators import dist, evaluate, nearest
from outcomelab.operators import model as M
from outcomelab.operators import target_stats as T
from outcomelab.operators.bagging import fit_bagged_forest
from outcomelab.operators.tuning import Study, tune_boosted, tune_boosted_stepwise
from outcomelab.plans.order_cohort import order_cohort, table
from outcomelab.session import stored

from .models import candidate, part, split_cohort
from .registry import check, rounded
from .scoring import scored
from .sql import on_cohort

FEATURES = ("n_lines", "qty", "price", "avg_disc", "avg_tax", "returned", "balance")
SMALL = B.BoostParams(rounds=6, patience=3, leaves=8, depth=4, rate=0.3, bins=16, metric="loss")
LEVEL = ("n_lines", "qty", "returned", "price")
LEVEL_BINS = 8


def fitting(spark, sf):
    """The cohort with its categories as target statistics: ordered in training, fitted elsewhere."""
    parts = split_cohort(spark, sf)
    train = part(parts, "train")
    fitted = T.fit_target_statistics(train, ["segment", "grp"], "label")
    own = T.ordered_target_statistics(train, ["segment", "grp"], "label", "id")
    rest = T.apply_target_statistics(part(parts, "val", "test"), fitted, ["segment", "grp"])
    # Read by bins, margins and scores: its shuffles are done once.
    return stored(own.unionByName(rest).withColumn("is_val", F.col("split") == "val"))


def boosted(rows, **more):
    features = [*FEATURES, "segment_stat", "grp_stat"]
    return B.fit_boosted(part(rows, "train", "val"), features, "label", replace(SMALL, **more),
                         "is_val", id_column="id")


@check("K1_second_order_boosting")
def _(spark, sf):
    rows = fitting(spark, sf)
    return boosted(rows).score(part(rows, "test")).select("id", "label", "score")


@check("K1_boosting_on_auc_with_samples")
def _(spark, sf):
    model = boosted(fitting(spark, sf), metric="auc", rounds=3, row_share=0.8, feature_share=0.7)
    return spark.createDataFrame(list(enumerate(model.history, 1)), "round int, auc double")


def level_sql():
    share = ", ".join(f"{i / LEVEL_BINS}::DOUBLE" for i in range(1, LEVEL_BINS))
    union = " UNION ALL ".join(
        f"""SELECT {k} AS feature, label, {c}::DOUBLE AS x,
        (SELECT list_sort(list_distinct(quantile_cont({c}::DOUBLE, [{share}]))) FROM cohort) AS e FROM cohort"""
        for k, c in enumerate(LEVEL))
    scale = f"{B.SCALE}::DOUBLE"
    worth = lambda s: f"coalesce((g_{s} / {scale}) * (g_{s} / {scale}) / nullif(h_{s} / {scale} + 1.0::DOUBLE, 0), 0)"
    return on_cohort(f"""
, base AS (SELECT ln(avg(label::DOUBLE) / (1 - avg(label::DOUBLE))) AS m FROM cohort),
p AS (SELECT 1 / (1 + exp(-m)) AS p FROM base),
binned AS (SELECT feature, CASE WHEN x IS NULL THEN 0 ELSE 1 + len(list_filter(e, lambda v: x > v)) END AS bin,
    round((p - label) * {scale})::BIGINT AS g, round(p * (1 - p) * {scale})::BIGINT AS h
  FROM ({union}), p),
hist AS (SELECT feature, bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS n FROM binned GROUP BY ALL),
sums AS (
  SELECT feature, bin, side AS missing_left,
    sum(g) OVER w AS g_all, sum(h) OVER w AS h_all, sum(n) OVER w AS n_all,
    sum(CASE WHEN bin > 0 THEN g ELSE 0 END) OVER u + CASE WHEN side THEN coalesce(max(CASE WHEN bin = 0 THEN g END) OVER w, 0) ELSE 0 END AS g_left,
    sum(CASE WHEN bin > 0 THEN h ELSE 0 END) OVER u + CASE WHEN side THEN coalesce(max(CASE WHEN bin = 0 THEN h END) OVER w, 0) ELSE 0 END AS h_left,
    sum(CASE WHEN bin > 0 THEN n ELSE 0 END) OVER u + CASE WHEN side THEN coalesce(max(CASE WHEN bin = 0 THEN n END) OVER w, 0) ELSE 0 END AS n_left
  FROM hist, (VALUES (true), (false)) AS s(side)
  WINDOW w AS (PARTITION BY feature, side), u AS (PARTITION BY feature, side ORDER BY bin)),
both_sides AS (SELECT *, g_all - g_left AS g_right, h_all - h_left AS h_right, n_all - n_left AS n_right
  FROM sums WHERE bin > 0)
SELECT feature::INTEGER AS feature, bin::SMALLINT AS bin, missing_left, n_left::BIGINT AS n_left, n_right::BIGINT AS n_right,
  round(CASE WHEN n_left >= 20 AND n_right >= 20 THEN {worth('left')} + {worth('right')} - {worth('all')} END, 6) AS gain
FROM both_sides""")


@check("K1_histogram_level", level_sql())
def _(spark, sf):
    """Gains of every cut at the root: histograms of exact gradient sums, both sides for missing values."""
    p = replace(SMALL, l2=1.0, bins=LEVEL_BINS, min_hessian=0.0)
    c = order_cohort(spark, sf)
    edges = B.bin_edges(c, LEVEL, p.bins)
    base = c.agg(F.log(F.avg("label") / (1 - F.avg("label"))).alias("m")).scalar()
    rows = B.gradients(B.with_bins(c, LEVEL, edges).select(
        F.col("label").alias("y"), F.lit(1.0).alias("w"), base.alias("margin"), "bins"))
    gains = B.split_gains(B.histograms(rows), p)
    return rounded(gains.select("feature", "bin", "missing_left", "n_left", "n_right", "gain"), "gain")


@check("K2_out_of_bag")
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label", "segment", *FEATURES)
    forest = fit_bagged_forest(c, "label", "id", FEATURES, ["segment"], trees=5, depth=5)
    return spark.createDataFrame(sorted(forest.oob.items()), "metric string, value double")


@check("K5_parzen_search_with_pruning")
def _(spark, sf):
    rows = part(fitting(spark, sf), "train", "val")
    study = Study({"depth": ("int", 2, 4), "rate": ("log", 0.05, 0.5)}, startup=2, prune=True, warm_trials=2)
    _, study = tune_boosted(rows, [*FEATURES, "segment_stat"], "label", "is_val", study, 3, replace(SMALL, rounds=2))
    return study.log(spark).select("trial", "value", "state", "rounds")


@check("K5_stepwise_search")
def _(spark, sf):
    rows = part(fitting(spark, sf), "train", "val")
    stages = [("depth", lambda best, rng: [{"depth": 2}]), ("min_rows", lambda best, rng: [{"min_rows": n} for n in (5, 50)])]
    _, log = tune_boosted_stepwise(rows, [*FEATURES, "grp_stat"], "label", "is_val",
                                   replace(SMALL, rounds=2, depth=3), stages=stages)
    return log.select("stage", "step", "value", "best")


@check("K7_gain_importance")
def _(spark, sf):
    return B.node_importance(boosted(fitting(spark, sf), rounds=3).nodes(spark))


@check("K7_forest_gains")
def _(spark, sf):
    parts = split_cohort(spark, sf)
    forest = M.fit(candidate("forest"), part(parts, "train"), "label")
    return B.node_importance(B.ensemble_nodes(forest.stages[-1], M.feature_names(forest, parts), spark))


@check("I4_ordered_target_statistics", on_cohort("""
, k AS (SELECT id, label, segment, md5(id || '|42') AS h, (SELECT avg(label) FROM cohort) AS prior FROM cohort)
SELECT id, segment, round((coalesce(sum(label) OVER w, 0) + prior) / (count(*) OVER w + 1), 6) AS segment_stat
FROM k WINDOW w AS (PARTITION BY segment ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label", "segment")
    out = T.ordered_target_statistics(c, ["segment"], "label", "id")
    return rounded(out.select("id", "segment", "segment_stat"), "segment_stat")


@check("I4_fitted_target_statistics", on_cohort("""
, l AS (SELECT grp, sum(label) AS s, count(*) AS n FROM cohort GROUP BY grp)
SELECT id, round((coalesce(s, 0) + (SELECT avg(label) FROM cohort)) / (coalesce(n, 0) + 1), 6) AS grp_stat
FROM cohort LEFT JOIN l USING (grp)"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label", "grp")
    out = T.apply_target_statistics(c, T.fit_target_statistics(c, ["grp"], "label"), ["grp"])
    return rounded(out.select("id", "grp_stat"), "grp_stat")


NEAREST = ("price", "qty", "balance", "returned")


def nearest_sql(c):
    psi = lambda n: (f"(ln({n} + 8.0::DOUBLE) - 1 / (2 * ({n} + 8.0::DOUBLE)) - 1 / (12 * pow({n} + 8.0::DOUBLE, 2))"  # noqa: E731
                     f" + 1 / (120 * pow({n} + 8.0::DOUBLE, 4)) - 1 / (252 * pow({n} + 8.0::DOUBLE, 6))"
                     f" + 1 / (240 * pow({n} + 8.0::DOUBLE, 8))"
                     + "".join(f" - 1 / ({n} + {j}.0::DOUBLE)" for j in range(8)) + ")")
    return f"""SELECT '{c}' AS feature, round(greatest(0, {psi('sum(n)')} + sum(n * {psi('k')}) / sum(n)
      - sum(n * {psi('size')}) / sum(n) - sum(n * {psi('m')}) / sum(n)), 6) AS mi
    FROM (SELECT a.n, a.k, a.size, CASE WHEN r > 0 THEN
        coalesce((SELECT max(c) FROM cum_{c} t WHERE t.x < a.x + r), 0) - coalesce((SELECT max(c) FROM cum_{c} t WHERE t.x <= a.x - r), 0)
        ELSE (SELECT own FROM cum_{c} t WHERE t.x = a.x) END AS m
      FROM (SELECT *, least(3, size - 1) AS k, list_sort(flatten(list_transform(near, lambda s:
              list_transform(range(0, least(3, s.n - CASE WHEN s.x = x THEN 1 ELSE 0 END)), lambda i: abs(s.x - x)))))[least(3, size - 1)::BIGINT] AS r
            FROM (SELECT label, x, n, sum(n) OVER (PARTITION BY label) AS size,
                    list({{'x': x, 'n': n}}) OVER (PARTITION BY label ORDER BY x ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near
                  FROM (SELECT label, {c}::DOUBLE AS x, count(*) AS n FROM cohort WHERE {c} IS NOT NULL GROUP BY ALL)) WHERE size > 1) a)"""


@check("I14_neighbour_information", on_cohort(", " + ", ".join(f"""cum_{c} AS (
  SELECT x, own, sum(own) OVER (ORDER BY x) AS c FROM (
    SELECT {c}::DOUBLE AS x, count(*) AS own FROM cohort WHERE {c} IS NOT NULL GROUP BY 1))""" for c in NEAREST)
    + " " + " UNION ALL ".join(map(nearest_sql, NEAREST))))
def _(spark, sf):
    return rounded(nearest.neighbour_information(order_cohort(spark, sf), NEAREST, "label"), "mi")


@check("F21_exact_rank_sum_test", """
WITH RECURSIVE mean_of AS (
  SELECT n_regionkey = 0 AS side, n_nationkey, avg(c_acctbal) AS v
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
ranked AS (SELECT side, rank() OVER (ORDER BY v) AS r FROM mean_of),
size AS (SELECT count(*) FILTER (NOT side) AS n_0, count(*) FILTER (side) AS n_1,
  sum(r) FILTER (NOT side) - count(*) FILTER (NOT side) * (count(*) FILTER (NOT side) + 1) / 2 AS u FROM ranked),
chosen AS (
  SELECT 0 AS r, 0 AS k, 0 AS total
  UNION ALL
  SELECT n.r::INTEGER, k + 1, (total + n.r)::INTEGER
  FROM chosen c JOIN ranked n ON n.r > c.r, size WHERE k < n_1),
ways AS (SELECT total - n_1 * (n_1 + 1) / 2 AS u, count(*) AS n FROM chosen, size WHERE k = n_1 GROUP BY 1)
SELECT n_0, n_1, round(u, 6) AS u, round(least(1, 2 * (SELECT sum(n) FROM ways WHERE ways.u >= greatest(size.u, n_0 * n_1 - size.u))
  / (SELECT sum(n) FROM ways)), 6) AS p_value FROM size""")
def _(spark, sf):
    """Mean balance of the nations of one region against the others: 5 and 20 values."""
    nations = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    means = nations.groupBy("n_regionkey", "n_nationkey").agg(F.avg("c_acctbal").alias("v"))
    test = dist.rank_sum_test(means.withColumn("side", (F.col("n_regionkey") == 0).cast("int")), "v", "side")
    return rounded(test.select("n_0", "n_1", "u", "p_value"), "u", "p_value")


@check("F21_p_value_of_the_normal_test", on_cohort("""
, k AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r,
          count(*) OVER (PARTITION BY score)::DOUBLE AS t FROM cohort WHERE score IS NOT NULL),
s AS (SELECT count(*) FILTER (label = 0)::DOUBLE AS a, count(*) FILTER (label = 1)::DOUBLE AS b,
        sum(r) FILTER (label = 0) AS r0, sum(t * t - 1) AS ties FROM k),
z AS (SELECT a, b, greatest(0, abs(r0 - a * (a + 1) / 2 - a * b / 2) - 0.5::DOUBLE)
        / sqrt(a * b / 12 * (a + b + 1 - ties / ((a + b) * (a + b - 1)))) AS z FROM s)
SELECT a::BIGINT AS n_0, b::BIGINT AS n_1, round(z, 6) AS z,
  round(CASE WHEN z > 6 THEN 0 ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 120), lambda n:
    pow(-1, n) * exp((2 * n + 1) * ln(greatest(z, 1e-300) / sqrt(2)) - lgamma(n + 1.0::DOUBLE)) / (2 * n + 1))) END, 6) AS p_value FROM z"""))
def _(spark, sf):
    test = dist.rank_sum_test(order_cohort(spark, sf), "score", "label")
    return rounded(test.select("n_0", "n_1", "z", "p_value"), "z", "p_value")


@check("J8_thinned_roc_points", on_cohort("""
, g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM cohort GROUP BY score),
s AS (SELECT score, p, n, lead(p) OVER w AS p2, lead(n) OVER w AS n2, row_number() OVER w AS i,
        sum(n) OVER w / sum(n) OVER ()::DOUBLE AS fpr, sum(p) OVER w / sum(p) OVER ()::DOUBLE AS tpr
      FROM g WINDOW w AS (ORDER BY score DESC))
SELECT score AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM s
WHERE i = 1 OR p2 IS NULL OR p2 <> p OR n2 <> n"""))
def _(spark, sf):
    points = evaluate.roc_points(scored(spark, sf), "label", "score", thinned=True)
    return rounded(points.where(F.col("threshold") != float("inf")), "fpr", "tpr")
