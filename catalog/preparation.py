"""I: preparation for models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from outcomelab.operators import assoc, prep, split
from outcomelab.operators.shape import shared_domain
from outcomelab.plans.order_cohort import order_cohort

from .cohorts import STATS
from .registry import check, rounded
from .sql import on_cohort

FILLED = ["qty", "price", "avg_disc"]


def fill_sql(function, where=""):
    stats = ", ".join(f"{function.format(c=c)} AS {c}_fill" for c in FILLED)
    cols = ", ".join(f"round(coalesce({c}, {c}_fill), 6) AS {c}" for c in FILLED)
    return on_cohort(f", f AS (SELECT {stats} FROM cohort {where}) SELECT id, {cols} FROM cohort, f")


@check("I1_fill_median", fill_sql("quantile_cont({c}, 0.5)"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", *FILLED)
    return rounded(prep.handle_missing(c, "median", columns=FILLED), *FILLED)


@check("I1_fill_mean_of_train", fill_sql("avg({c})", "WHERE id % 5 <> 0"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", *FILLED)
    train = c.where(F.col("id") % 5 != 0)
    return rounded(prep.handle_missing(c, "mean", fit_on=train, columns=FILLED), *FILLED)


@check("I1_drop_missing", on_cohort(
    "SELECT id, qty FROM cohort WHERE qty IS NOT NULL"))
def _(spark, sf):
    return prep.handle_missing(order_cohort(spark, sf).select("id", "qty"), "drop")


def mode_sql(column):
    return f"""(SELECT {column} FROM train WHERE {column} IS NOT NULL
               GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"""


@check("I2_fill_train_mode", on_cohort(f"""
, shaped AS (SELECT id, n_lines, returned, CASE WHEN n_lines IS NOT NULL THEN segment END AS seg
             FROM cohort),
train AS (SELECT * FROM shaped WHERE id % 5 <> 0)
SELECT id, coalesce(n_lines, {mode_sql('n_lines')}) AS n_lines,
       coalesce(returned, {mode_sql('returned')}) AS returned,
       coalesce(seg, {mode_sql('seg')}) AS seg FROM shaped"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select(
        "id", "n_lines", "returned",
        F.when(F.col("n_lines").isNotNull(), F.col("segment")).alias("seg"))
    return prep.apply_fill(c, prep.fit_modes(c.where(F.col("id") % 5 != 0), target="id"))


@check("I2_modes", on_cohort("""
, n AS (SELECT 'qty' AS "column", qty AS v, count(*) AS n FROM cohort WHERE qty IS NOT NULL GROUP BY qty
  UNION ALL SELECT 'balance', balance, count(*) FROM cohort GROUP BY balance)
SELECT "column", CAST(NULL AS VARCHAR) AS text_value, v AS number_value FROM n
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) = 1"""))
def _(spark, sf):
    return prep.modes(order_cohort(spark, sf), ["qty", "balance"])


@check("I3_standardise", on_cohort("""
, s AS (SELECT avg(qty) AS qm, stddev_pop(qty) AS qs, avg(price) AS pm, stddev_pop(price) AS ps
        FROM cohort WHERE id % 5 <> 0)
SELECT id, round((qty - qm) / qs, 6) AS qty, round((price - pm) / ps, 6) AS price
FROM cohort, s"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "qty", "price")
    scaler = prep.fit_scaler(c.where(F.col("id") % 5 != 0), ["qty", "price"])
    return rounded(scaler.apply(c), "qty", "price")


@check("I3_scale_only", on_cohort("""
, s AS (SELECT stddev_pop(qty) AS qs FROM cohort)
SELECT id, round(qty / qs, 6) AS qty FROM cohort, s"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "qty")
    return rounded(prep.fit_scaler(c, ["qty"], with_mean=False).apply(c), "qty")


@check("I4_label_codes", on_cohort("""
, f AS (SELECT id, coalesce(CASE WHEN n_lines > 3 THEN segment END, 'missing') AS seg,
               coalesce(grp, 'missing') AS grp FROM cohort)
SELECT id, CAST(dense_rank() OVER (ORDER BY seg) - 1 AS INTEGER) AS seg_encoded,
       CAST(dense_rank() OVER (ORDER BY grp) - 1 AS INTEGER) AS grp_encoded FROM f"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select(
        "id", F.when(F.col("n_lines") > 3, F.col("segment")).alias("seg"), "grp")
    return prep.apply_codes(c, prep.fit_codes(c, ["seg", "grp"]))


@check("I5_one_hot", on_cohort("""
SELECT id, CAST(segment = 'AUTOMOBILE' AS DOUBLE) AS s0, CAST(segment = 'BUILDING' AS DOUBLE) AS s1,
       CAST(segment = 'FURNITURE' AS DOUBLE) AS s2, CAST(segment = 'MACHINERY' AS DOUBLE) AS s3
FROM cohort"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "segment")
    # One level is held back from the fit and must come out as all zeros.
    fitted = Pipeline(stages=prep.one_hot_stages(["segment"])).fit(
        c.where(F.col("segment") != "HOUSEHOLD"))
    slots = vector_to_array("segment_onehot")
    return fitted.transform(c).select("id", *[slots[i].alias(f"s{i}") for i in range(4)])


@check("I6_rare_levels", on_cohort("""
, l AS (SELECT grp, count(*) AS n FROM cohort WHERE grp <> 'NATION_7' GROUP BY grp),
lim AS (SELECT sum(n) * 0.04 AS x FROM l)
SELECT id, CASE WHEN n IS NULL THEN NULL WHEN n >= x THEN cohort.grp ELSE '__infrequent__' END AS grp
FROM cohort LEFT JOIN l ON l.grp = cohort.grp, lim"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "grp")
    levels = prep.level_table(c.where(F.col("grp") != "NATION_7"), "grp", 0.04)
    return prep.group_rare_levels(c, levels, "grp")


@check("I7_domain_sizes", on_cohort("""
SELECT 'segment' AS "column", count(DISTINCT segment) AS categories FROM cohort
UNION ALL SELECT 'grp', count(DISTINCT grp) FROM cohort"""))
def _(spark, sf):
    return prep.domain_sizes(order_cohort(spark, sf), ["segment", "grp"])


@check("I7_shared_codes", on_cohort("""
SELECT id, CAST(dense_rank() OVER (ORDER BY grp) - 1 AS INTEGER) AS grp_encoded FROM cohort"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "grp")
    parts = [c.where(F.col("id") % 3 == i) for i in range(3)]
    domain = shared_domain(parts, ["grp"]).select(F.col("value").alias("grp"))
    return prep.apply_codes(c, prep.fit_codes(domain, ["grp"]))


@check("I8_assemble", on_cohort("""
SELECT id, coalesce(qty, 0) AS x0, coalesce(price, 0) AS x1,
       CAST(dense_rank() OVER (ORDER BY segment) - 1 AS DOUBLE) AS x2 FROM cohort"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "qty", "price", "segment").na.fill(0.0)
    coded = prep.fit_codes(c, ["segment"]).transform(c)
    x = vector_to_array("features")
    return prep.assembler(["qty", "price"], ["segment_encoded"]).transform(coded).select(
        "id", *[x[i].alias(f"x{i}") for i in range(3)])


@check("I9_class_weights", on_cohort("""
, t AS (SELECT count(*) AS n, count(DISTINCT label) AS k, sum(label) AS pos FROM cohort)
SELECT label, count(*) AS n, round(any_value(t.n)::DOUBLE / (any_value(k) * count(*)), 6) AS balanced,
  round(CASE WHEN label = 1 THEN any_value(t.n - pos)::DOUBLE / any_value(pos) ELSE 1 END, 6)
  AS positive FROM cohort, t GROUP BY label"""))
def _(spark, sf):
    return rounded(prep.class_weights(order_cohort(spark, sf), "label"), "balanced", "positive")


def split_sql(test, val=None, seed=42):
    """Class ranks by hash, and how many of each class the parts hold."""
    kept = """
    SELECT label, n_c, left_total, left_total * n_c // n_all
      + CASE WHEN row_number() OVER (ORDER BY left_total * n_c % n_all DESC, label)
             <= left_total - sum(left_total * n_c // n_all) OVER () THEN 1 ELSE 0 END AS left_c
    FROM sizes"""
    ctes = f"""
, ranked AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(id || '|{seed}')) AS r
             FROM cohort),
sizes AS (SELECT label, count(*) AS n_c, sum(count(*)) OVER () AS n_all,
                 sum(count(*)) OVER () - CAST(ceil({test}::DOUBLE * sum(count(*)) OVER ()) AS BIGINT)
                 AS left_total FROM cohort GROUP BY label),
kept AS ({kept})"""
    if val is None:
        return ctes + """
SELECT id, CASE WHEN r <= n_c - left_c THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN kept USING (label)"""
    return ctes + f""",
second AS (SELECT label, n_c, left_c, left_total, left_total
  - CAST(ceil({val}::DOUBLE / (1 - {test}::DOUBLE) * left_total) AS BIGINT) AS train_total FROM kept),
trained AS (SELECT *, train_total * left_c // left_total
  + CASE WHEN row_number() OVER (ORDER BY train_total * left_c % left_total DESC, label)
         <= train_total - sum(train_total * left_c // left_total) OVER () THEN 1 ELSE 0 END AS train_c
  FROM second)
SELECT id, CASE WHEN r <= n_c - left_c THEN 'test' WHEN r <= n_c - train_c THEN 'val'
                ELSE 'train' END AS split
FROM ranked JOIN trained USING (label)"""


@check("I10_split_60_20_20", on_cohort(split_sql(0.2, 0.2)))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label")
    return split.stratified_split(c, "label", "id", 0.2, 0.2).select("id", "split")


@check("I10_split_70_15_15", on_cohort(split_sql(0.15, 0.15, seed=7)))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label")
    return split.stratified_split(c, "label", "id", 0.15, 0.15, seed=7).select("id", "split")


@check("I10_split_report", on_cohort(split_sql(0.15, 0.15).replace(
    "SELECT id, CASE WHEN r <= n_c - left_c", """
, parts AS (SELECT id, label, CASE WHEN r <= n_c - left_c""") + """)
SELECT split, count(*) AS n, round(count(*) / (SELECT count(*)::DOUBLE FROM cohort), 6) AS share,
       round(avg(label), 6) AS rate FROM parts GROUP BY split"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label")
    parts = split.stratified_split(c, "label", "id", 0.15, 0.15)
    return rounded(split.split_report(parts, "label"), "share", "rate")


@check("I11_split_80_20", on_cohort(split_sql(0.2)))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label")
    return split.stratified_split(c, "label", "id", 0.2).select("id", "split")


@check("I12_folds", on_cohort("""
, ranked AS (SELECT id, row_number() OVER (PARTITION BY label ORDER BY md5(id || '|42')) AS r,
                    count(*) OVER (PARTITION BY label) AS n FROM cohort)
SELECT id, CAST((r > n // 5)::INT + (r > n * 2 // 5)::INT + (r > n * 3 // 5)::INT
                + (r > n * 4 // 5)::INT AS INTEGER) AS fold FROM ranked"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label")
    return split.stratified_folds(c, "label", "id").select("id", "fold")


def anova_sql(columns):
    return " UNION ALL ".join(f"""
SELECT '{c}' AS feature, sum(n * pow(m - g, 2)) / (count(*) - 1)
       / (sum(n * v) / (sum(n) - count(*))) AS f
FROM (SELECT label, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v,
             (SELECT avg({c}) FROM cohort) AS g FROM cohort GROUP BY label)""" for c in columns)


@check("I13_anova", on_cohort(
    f"SELECT feature, round(f, 6) AS f FROM ({anova_sql(STATS)}) ORDER BY f DESC, feature LIMIT 5"))
def _(spark, sf):
    return rounded(assoc.anova_f(order_cohort(spark, sf), STATS, "label", top=5), "f")


MI = ["qty", "price", "balance", "score", "returned"]


def mi_sql(column):
    return f"""
SELECT '{column}' AS feature, sum(p * ln(p / (px * py))) AS mi FROM (
  SELECT n / t AS p, sum(n) OVER (PARTITION BY bin) / t AS px,
         sum(n) OVER (PARTITION BY label) / t AS py FROM (
    SELECT bin, label, count(*)::DOUBLE AS n, sum(count(*)) OVER ()::DOUBLE AS t FROM (
      SELECT label, greatest(1, len(list_filter(e, lambda v: v < {column}))) AS bin
      FROM cohort, (SELECT list_distinct(quantile_cont({column}, {[i / 10 for i in range(11)]})) AS e
                    FROM cohort) WHERE {column} IS NOT NULL)
    GROUP BY bin, label))"""


@check("I14_mutual_information", on_cohort(f"""
SELECT feature, round(mi, 6) AS mi FROM ({' UNION ALL '.join(map(mi_sql, MI))})"""))
def _(spark, sf):
    return rounded(assoc.mutual_information(order_cohort(spark, sf), MI, "label"), "mi")


@check("I13_selected_columns", on_cohort("SELECT id, score, score_b FROM cohort"))
def _(spark, sf):
    c = order_cohort(spark, sf)
    ranking = assoc.anova_f(c, ["score", "score_b", "balance", "price", "avg_tax"], "label", top=2)
    return assoc.keep_ranked(c, ranking, ["id"])
