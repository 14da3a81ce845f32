"""F: profiles, cohort statistics, bins, distributions, association."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelab.operators import assoc, bins, cohort, dist, profile
from outcomelab.operators.derive import apply_recipe
from outcomelab.plans import recipes as R
from outcomelab.plans.order_cohort import order_cohort, season_table, table

from .registry import check, rounded
from .sql import on_cohort, on_season

STATS = ["n_lines", "qty", "max_qty", "price", "avg_disc", "avg_tax", "returned", "balance"]
PROFILED = [("id", "bigint", "numeric"), ("label", "int", "numeric"),
            ("segment", "string", "categorical"), ("grp", "string", "categorical"),
            ("qty", "double", "numeric"), ("price", "double", "numeric"),
            ("avg_disc", "double", "numeric")]


def profile_sql(where: str = "") -> str:
    parts = [f"""SELECT '{c}' AS "column", '{t}' AS "type", '{k}' AS kind, count({c}) AS non_null,
      count(*) - count({c}) AS nulls,
      round((count(*) - count({c}))::DOUBLE / count(*) * 100, 6) AS null_pct,
      count(DISTINCT {c}) AS "distinct" FROM cohort""" for c, t, k in PROFILED]
    return on_cohort(f"SELECT * FROM ({' UNION ALL '.join(parts)}) {where}")


@check("F1_column_profile", profile_sql())
def _(spark, sf):
    c = order_cohort(spark, sf).select(*[p[0] for p in PROFILED])
    return rounded(profile.column_profile(c), "null_pct")


@check("F1_missing_columns", profile_sql("WHERE nulls > 0"))
def _(spark, sf):
    c = order_cohort(spark, sf).select(*[p[0] for p in PROFILED])
    return rounded(profile.column_profile(c, only_missing=True), "null_pct")


@check("F1_column_kinds", on_cohort(
    """SELECT 'qty' AS name, 'numeric' AS kind, count(qty) AS non_null FROM cohort
       UNION ALL SELECT 'segment', 'categorical', count(segment) FROM cohort"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("segment", "qty")
    numeric, text = profile.column_kinds(c)
    kinds = {**dict.fromkeys(numeric, "numeric"), **dict.fromkeys(text, "categorical")}
    counts = c.agg(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind"),
                              F.count(n).alias("non_null")).alias(n) for n, k in kinds.items()])
    return counts.select(F.inline(F.array(*kinds)))


@check("F2_value_counts", on_cohort("SELECT segment, count(*) AS n FROM cohort GROUP BY segment"))
def _(spark, sf):
    return profile.value_counts(order_cohort(spark, sf), "segment")


@check("F3_overall_rate", on_cohort("""
SELECT CAST(sum(label) AS BIGINT) AS positives, count(label) AS n, round(avg(label), 6) AS rate
FROM cohort"""))
def _(spark, sf):
    return rounded(profile.overall_rate(order_cohort(spark, sf), "label"), "rate")


@check("F4_group_rate_top20", on_cohort("""
SELECT grp, CAST(sum(label) AS BIGINT) AS positives, count(label) AS n, round(avg(label), 6) AS rate
FROM cohort WHERE grp IS NOT NULL GROUP BY grp ORDER BY avg(label) DESC, grp LIMIT 20"""))
def _(spark, sf):
    return rounded(cohort.group_rate(order_cohort(spark, sf), "grp", "label", top=20), "rate")


@check("F4_group_rate_by_positives", on_cohort("""
SELECT grp, CAST(sum(label) AS BIGINT) AS positives, count(label) AS n, round(avg(label), 6) AS rate
FROM cohort WHERE grp IS NOT NULL GROUP BY grp HAVING sum(label) > 0
ORDER BY sum(label) DESC, grp LIMIT 15"""))
def _(spark, sf):
    return rounded(cohort.group_rate(order_cohort(spark, sf), "grp", "label", "positives", 15,
                                     positives_only=True), "rate")


@check("F4_part_return_rate", """
SELECT l_partkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positives,
       count(*) AS n, round(avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 6) AS rate
FROM lineitem GROUP BY l_partkey
ORDER BY positives DESC, l_partkey LIMIT 10""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_partkey", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    return rounded(cohort.group_rate(lines, "l_partkey", "returned", "positives", 10), "rate")


FLAGGED = """
, flagged AS (SELECT label, CASE WHEN qty > 150 THEN 1 ELSE 0 END AS big,
                     CASE WHEN returned > 2 THEN 1 ELSE 0 END AS often FROM cohort)"""


def flagged(spark, sf):
    c = order_cohort(spark, sf)
    return c.select("label", F.coalesce(F.col("qty") > 150, F.lit(False)).cast("int").alias("big"),
                    F.coalesce(F.col("returned") > 2, F.lit(False)).cast("int").alias("often"))


@check("F5_flag_rates", on_cohort(FLAGGED + """
SELECT 'big' AS "group", count(label) AS n, round(avg(label), 6) AS rate FROM flagged WHERE big = 1
UNION ALL SELECT 'often', count(label), round(avg(label), 6) FROM flagged WHERE often = 1
UNION ALL SELECT 'neither', count(label), round(avg(label), 6) FROM flagged
          WHERE big = 0 AND often = 0"""))
def _(spark, sf):
    return rounded(cohort.flag_rates(flagged(spark, sf), ["big", "often"], "label"), "rate")


@check("F5_rate_by_flag", on_cohort(FLAGGED + """
SELECT often, count(label) AS n, round(avg(label), 6) AS rate FROM flagged GROUP BY often"""))
def _(spark, sf):
    return rounded(cohort.rate_by_flag(flagged(spark, sf), "often", "label"), "rate")


@check("F6_rate_lift", on_cohort(FLAGGED + """
SELECT round(a, 6) AS rate_in, round(b, 6) AS rate_out, round(a / b, 6) AS lift FROM (
  SELECT avg(CASE WHEN big = 1 THEN label END) AS a,
         avg(CASE WHEN big = 0 THEN label END) AS b FROM flagged)"""))
def _(spark, sf):
    return rounded(cohort.rate_lift(flagged(spark, sf), "big", "label"),
                   "rate_in", "rate_out", "lift")


@check("F7_crosstab", on_cohort("""
SELECT grp, count(CASE WHEN label = 0 THEN 1 END) AS n_0, count(CASE WHEN label = 1 THEN 1 END)
       AS n_1, count(*) AS total,
       round(count(CASE WHEN label = 1 THEN 1 END) * 100.0::DOUBLE / count(*), 6) AS positive_pct
FROM cohort GROUP BY grp"""))
def _(spark, sf):
    return rounded(cohort.crosstab(order_cohort(spark, sf), "grp", "label"), "positive_pct")


def class_means_sql(columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", avg(CASE WHEN label = 0 THEN {c} END) AS a,
            avg(CASE WHEN label = 1 THEN {c} END) AS b FROM cohort""" for c in columns)


@check("F8_class_means", on_cohort(f"""
SELECT "column", round(a, 6) AS mean_0, round(b, 6) AS mean_1
FROM ({class_means_sql(STATS)})"""))
def _(spark, sf):
    return rounded(cohort.class_means(order_cohort(spark, sf), STATS, "label"),
                   "mean_0", "mean_1")


@check("F8_scaled_class_means", on_cohort(f"""
SELECT "column", round(a, 6) AS mean_0, round(b, 6) AS mean_1,
       round(a / CASE WHEN greatest(a, b) > 0 THEN greatest(a, b) ELSE 1 END, 6) AS scaled_0,
       round(b / CASE WHEN greatest(a, b) > 0 THEN greatest(a, b) ELSE 1 END, 6) AS scaled_1
FROM ({class_means_sql(STATS)})"""))
def _(spark, sf):
    return rounded(cohort.class_means(order_cohort(spark, sf), STATS, "label", scaled=True),
                   "mean_0", "mean_1", "scaled_0", "scaled_1")


DESCRIBE = ("mean", "std", "min", "q25", "q50", "q75", "max")


def describe_sql(columns, key=""):
    select = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return " UNION ALL ".join(
        f"""SELECT {select}'{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
            round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
            round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max
            FROM cohort {group}""" for c in columns)


@check("F9_describe", on_cohort(describe_sql(STATS)))
def _(spark, sf):
    return rounded(profile.describe(order_cohort(spark, sf), STATS), *DESCRIBE)


@check("F9_describe_by_class", on_cohort(describe_sql(["qty", "balance"], "label")))
def _(spark, sf):
    return rounded(profile.describe(order_cohort(spark, sf), ["qty", "balance"], "label"),
                   *DESCRIBE)


@check("F10_class_summary", on_cohort("""
, s AS (SELECT label, avg(price) AS m, quantile_cont(price, 0.5) AS q, stddev_samp(price) AS sd,
               min(price) AS lo, max(price) AS hi FROM cohort GROUP BY label),
p AS (SELECT a.m AS m0, b.m AS m1, a.q AS q0, b.q AS q1, a.sd AS s0, b.sd AS s1,
             a.lo AS l0, b.lo AS l1, a.hi AS h0, b.hi AS h1
      FROM s a, s b WHERE a.label = 0 AND b.label = 1)
SELECT 'mean' AS stat, round(m0, 4) AS value_0, round(m1, 4) AS value_1,
       round(m1 - m0, 4) AS difference FROM p
UNION ALL SELECT 'median', round(q0, 4), round(q1, 4), round(q1 - q0, 4) FROM p
UNION ALL SELECT 'std', round(s0, 4), round(s1, 4), NULL FROM p
UNION ALL SELECT 'min', round(l0, 4), round(l1, 4), NULL FROM p
UNION ALL SELECT 'max', round(h0, 4), round(h1, 4), NULL FROM p"""))
def _(spark, sf):
    out = cohort.class_summary(order_cohort(spark, sf), "price", "label")
    return out.select("stat", *[F.round(c, 4).alias(c)
                                for c in ("value_0", "value_1", "difference")])


@check("F11_class_percentiles", on_cohort("""
SELECT CAST(p AS INTEGER) AS percent,
  round((SELECT quantile_cont(qty, [0.25,0.5,0.75,0.9,0.95,0.99]) FROM cohort WHERE label = 0)[i], 6)
    AS value_0,
  round((SELECT quantile_cont(qty, [0.25,0.5,0.75,0.9,0.95,0.99]) FROM cohort WHERE label = 1)[i], 6)
    AS value_1
FROM (VALUES (25, 1), (50, 2), (75, 3), (90, 4), (95, 5), (99, 6)) v(p, i)"""))
def _(spark, sf):
    return rounded(cohort.class_percentiles(order_cohort(spark, sf), "qty", "label"),
                   "value_0", "value_1")


def correlations_sql(columns, where=""):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({c}, label) AS r FROM cohort" for c in columns)


@check("F12_target_correlations", on_cohort(f"""
SELECT feature, round(r, 6) AS r, round(abs(r), 6) AS abs_r
FROM ({correlations_sql(STATS + ['score', 'score_b', 'score_c'])})
ORDER BY abs(r) DESC, feature LIMIT 5"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("label", *STATS, "score", "score_b", "score_c")
    return rounded(assoc.target_correlations(c, "label", top=5), "r", "abs_r")


def pairs_sql(columns):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM cohort"
        for i, a in enumerate(columns) for b in columns[i + 1:])


@check("F13_correlation_pairs", on_cohort(
    f"SELECT a, b, round(r, 6) AS r FROM ({pairs_sql(STATS)})"))
def _(spark, sf):
    return rounded(assoc.correlation_pairs(order_cohort(spark, sf), STATS), "r")


@check("F13_strong_pairs", on_cohort(
    f"SELECT a, b, round(r, 6) AS r FROM ({pairs_sql(STATS)}) WHERE r >= 0.8"))
def _(spark, sf):
    return rounded(assoc.correlation_pairs(order_cohort(spark, sf), STATS, min_r=0.8), "r")


@check("F13_strongest_features", on_cohort(f"""
, best AS (SELECT feature FROM ({correlations_sql(STATS)}) ORDER BY abs(r) DESC, feature LIMIT 4)
SELECT least(a, b) AS a, greatest(a, b) AS b, round(r, 6) AS r FROM ({pairs_sql(STATS)})
WHERE a IN (SELECT feature FROM best) AND b IN (SELECT feature FROM best)"""))
def _(spark, sf):
    out = assoc.strongest_pairs(order_cohort(spark, sf), "label", STATS, 4)
    return rounded(out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "r"),
                   "r")


def equal_width_sql(column):
    return on_cohort(f"""
, r AS (SELECT min({column}) AS lo, max({column}) AS hi FROM cohort),
b AS (SELECT CAST(1 + list_sum(list_transform(range(1, 10),
             lambda i: CAST({column} > lo + (hi - lo) / 10 * i AS INTEGER))) AS INTEGER) AS bin,
             lo, hi, label FROM cohort, r WHERE {column} IS NOT NULL)
SELECT bin, round(any_value(lo + (hi - lo) / 10 * (bin - 1)), 6) AS lo,
       round(any_value(lo + (hi - lo) / 10 * bin), 6) AS hi, count(*) AS n,
       round(avg(label), 6) AS rate FROM b GROUP BY bin""")


@check("F14_equal_width_rate", equal_width_sql("balance"))
def _(spark, sf):
    return rounded(bins.equal_width_rate(order_cohort(spark, sf), "balance", "label"),
                   "lo", "hi", "rate")


@check("F14_equal_width_rate_with_nulls", equal_width_sql("qty"))
def _(spark, sf):
    return rounded(bins.equal_width_rate(order_cohort(spark, sf), "qty", "label"),
                   "lo", "hi", "rate")


@check("F15_edge_rate", on_cohort("""
SELECT bin, CAST([0, 50, 100, 200][bin] AS DOUBLE) AS lo,
       CAST([50, 100, 200, 500][bin] AS DOUBLE) AS hi, count(*) AS n, round(avg(label), 6) AS rate
FROM (SELECT label, CAST(CASE WHEN qty <= 0 THEN NULL WHEN qty <= 50 THEN 1 WHEN qty <= 100 THEN 2
             WHEN qty <= 200 THEN 3 WHEN qty <= 500 THEN 4 END AS INTEGER) AS bin FROM cohort)
WHERE bin IS NOT NULL GROUP BY bin"""))
def _(spark, sf):
    return rounded(bins.edge_rate(order_cohort(spark, sf), "qty", "label",
                                  [0, 50, 100, 200, 500]), "rate")


def quantile_rate_sql(column, probs):
    return on_cohort(f"""
, q AS (SELECT list_sort(list_distinct(quantile_cont({column}, {probs}))) AS e FROM cohort),
b AS (SELECT CAST(greatest(1, len(list_filter(e, lambda v: v < {column}))) AS INTEGER) AS bin,
             e, label FROM cohort, q WHERE {column} IS NOT NULL)
SELECT bin, round(any_value(e[bin]), 6) AS lo, round(any_value(e[bin + 1]), 6) AS hi,
       count(*) AS n, round(avg(label), 6) AS rate FROM b GROUP BY bin""")


DECILES = [i / 10 for i in range(11)]


@check("F16_decile_rate", quantile_rate_sql("price", DECILES))
def _(spark, sf):
    return rounded(bins.quantile_rate(order_cohort(spark, sf), "price", "label", 10),
                   "lo", "hi", "rate")


@check("F16_quintile_rate_with_ties", quantile_rate_sql("returned", [i / 5 for i in range(6)]))
def _(spark, sf):
    return rounded(bins.quantile_rate(order_cohort(spark, sf), "returned", "label", 5),
                   "lo", "hi", "rate")


def histogram_sql(column, n):
    return on_cohort(f"""
, r AS (SELECT label, min({column}) AS lo, max({column}) AS hi, count({column}) AS size
        FROM cohort GROUP BY label),
b AS (SELECT c.label, CAST(1 + list_sum(list_transform(range(1, {n}),
             lambda i: CAST({column} >= lo + (hi - lo) / {n} * i AS INTEGER))) AS INTEGER) AS bin,
             lo, (hi - lo) / {n} AS w, size
      FROM cohort c JOIN r USING (label) WHERE {column} IS NOT NULL)
SELECT label AS class, bin, round(any_value(lo + w * (bin - 1)), 6) AS lo,
       round(any_value(lo + w * bin), 6) AS hi, count(*) AS n,
       round(count(*) / any_value(size * w), 6) AS density FROM b GROUP BY label, bin""")


@check("F17_histogram", histogram_sql("price", 30))
def _(spark, sf):
    return rounded(dist.histogram(order_cohort(spark, sf), "price", "label", 30),
                   "lo", "hi", "density")


@check("F18_density", on_cohort("""
, r AS (SELECT label, min(qty) AS lo, max(qty) AS hi, count(qty) AS size,
               stddev_samp(qty) * pow(count(qty)::DOUBLE, -0.2) AS h
        FROM cohort GROUP BY label),
b AS (SELECT c.label, 1 + list_sum(list_transform(range(1, 128),
             lambda i: CAST(qty >= lo + (hi - lo) / 128 * i AS INTEGER))) AS bin
      FROM cohort c JOIN r USING (label) WHERE qty IS NOT NULL),
n AS (SELECT label, bin, count(*) AS n FROM b GROUP BY label, bin),
g AS (SELECT label, CAST(s AS INTEGER) AS step,
             lo - (hi - lo) * 0.5 + (hi - lo) * 2 / 99 * s AS x FROM r, range(0, 100) t(s))
SELECT g.label AS class, g.step, round(x, 6) AS x,
       round(sum(n * exp(-pow((x - (lo + (hi - lo) / 128 * (bin - 0.5))) / h, 2) / 2)
                 / (size * h * sqrt(2 * pi()))), 6) AS density
FROM g JOIN n USING (label) JOIN r USING (label) GROUP BY g.label, g.step, x"""))
def _(spark, sf):
    out = dist.density(order_cohort(spark, sf), "qty", "label", grid=100, bins=128)
    return rounded(out, "x", "density")


def box_sql(column, key, where=""):
    return on_cohort(f"""
, q AS (SELECT {key}, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS m,
               quantile_cont({column}, 0.75) AS q3 FROM cohort {where} GROUP BY {key}),
x AS (SELECT c.{key}, {column} AS v, q1, m, q3, q1 - 1.5 * (q3 - q1) AS lo,
             q3 + 1.5 * (q3 - q1) AS hi FROM cohort c JOIN q USING ({key})
      WHERE {column} IS NOT NULL)
SELECT {key}, count(*) AS n, round(avg(v), 6) AS mean, min(v) AS min, max(v) AS max,
  round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3,
  round(least(min(CASE WHEN v >= lo THEN v END), any_value(q1)), 6) AS whisker_low,
  round(greatest(max(CASE WHEN v <= hi THEN v END), any_value(q3)), 6) AS whisker_high,
  count(CASE WHEN v < lo OR v > hi THEN 1 END) AS outliers,
  round(any_value(m) - 1.57 * any_value(q3 - q1) / sqrt(count(*)), 6) AS notch_low,
  round(any_value(m) + 1.57 * any_value(q3 - q1) / sqrt(count(*)), 6) AS notch_high
FROM x GROUP BY {key}""")


BOXED = ("mean", "q1", "median", "q3", "whisker_low", "whisker_high", "notch_low", "notch_high")


@check("F19_box_summary", box_sql("qty", "label"))
def _(spark, sf):
    return rounded(dist.box_summary(order_cohort(spark, sf), "qty", "label"), *BOXED)


@check("F20_box_by_top_categories", box_sql("balance", "grp", """
WHERE grp IN (SELECT grp FROM cohort GROUP BY grp ORDER BY count(*) DESC, grp LIMIT 5)"""))
def _(spark, sf):
    return rounded(dist.box_by_top_categories(order_cohort(spark, sf), "balance", "grp"), *BOXED)


@check("F21_rank_sum", on_cohort("""
, k AS (SELECT label, rank() OVER (ORDER BY qty)
               + (count(*) OVER (PARTITION BY qty) - 1) / 2.0::DOUBLE AS r
        FROM cohort WHERE qty IS NOT NULL),
t AS (SELECT sum(n::DOUBLE * n * n - n) AS ties
      FROM (SELECT count(*) AS n FROM cohort WHERE qty IS NOT NULL GROUP BY qty))
SELECT count(CASE WHEN label = 0 THEN 1 END) AS n_0, count(CASE WHEN label = 1 THEN 1 END) AS n_1,
  sum(CASE WHEN label = 0 THEN r ELSE 0 END) - count(CASE WHEN label = 0 THEN 1 END)
    * (count(CASE WHEN label = 0 THEN 1 END) + 1) / 2.0::DOUBLE AS u, any_value(ties) AS ties
FROM k, t"""))
def _(spark, sf):
    return dist.rank_sum_u(order_cohort(spark, sf), "qty", "label")


@check("F21_rank_sum_test")
def _(spark, sf):
    return dist.rank_sum_test(order_cohort(spark, sf), "score", "label")


@check("F7_flag_crosstab", on_season("""
SELECT CASE WHEN "Rec_Rank" IS NOT NULL THEN 1 ELSE 0 END AS has_recruit_rank,
  count(CASE WHEN drafted = 0 THEN 1 END) AS n_0, count(CASE WHEN drafted = 1 THEN 1 END) AS n_1,
  count(*) AS total,
  round(count(CASE WHEN drafted = 1 THEN 1 END) * 100.0::DOUBLE / count(*), 6) AS positive_pct
FROM season GROUP BY 1"""))
def _(spark, sf):
    flags = apply_recipe(season_table(spark, sf), R.BIG_MEN)
    return rounded(cohort.crosstab(flags, "has_recruit_rank", "drafted"), "positive_pct")
