"""B, C, H: projections, filters, alignment without position, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelab.functions.height import height_inches
from outcomelab.operators import shape
from outcomelab.operators.derive import all_above, apply_recipe, fit_thresholds
from outcomelab.operators.prep import apply_fill, fit_modes
from outcomelab.operators.score import add_prediction
from outcomelab.plans.order_cohort import height_table, order_cohort, table

from .registry import check
from .sql import on_cohort, on_heights


@check("B1_split_features_target", on_cohort("SELECT id, segment, qty, label FROM cohort"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("label", "id", "segment", "qty",
                                       F.col("n_lines").alias("pick"))
    return shape.split_features_target(c, "label")


@check("B2_select_features", on_cohort("SELECT segment, qty, price FROM cohort"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label", "segment", "qty", "price", "balance", "grp")
    other = c.drop("balance", "label")
    return shape.select_features(c, "label", ["grp"], shared_with=other)


@check("B5_promote_numeric", """
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
       o_orderstatus, o_totalprice FROM orders""")
def _(spark, sf):
    return shape.promote_numeric(table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


@check("B6_target_from_pick", on_cohort("""
SELECT id, CAST(coalesce(returned - 1 > 0, false) AS INTEGER) AS drafted FROM cohort"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", (F.col("returned") - 1).alias("pick"))
    return shape.define_target(c).select("id", "drafted")


@check("B6_target_cast", on_cohort("SELECT id, label AS drafted FROM cohort"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", F.col("label").cast("double").alias("drafted"))
    return shape.define_target(c)


@check("B7_class_rows", on_cohort(
    "SELECT id, label, qty FROM cohort WHERE label = 1 AND qty IS NOT NULL"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label", "qty")
    return shape.rows_of_class(c, "label", 1, ["qty"])


@check("B8_drop_incomplete", on_cohort(
    "SELECT id, qty, price FROM cohort WHERE qty IS NOT NULL AND price IS NOT NULL"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "qty", "price")
    return shape.drop_incomplete(c, ["qty", "price"])


@check("B9_rejected_values", on_heights(r"""
SELECT DISTINCT ht FROM heights
WHERE ht IS NOT NULL AND NOT (
  regexp_matches(trim(ht), '^\d{1,2}[-/](?i:may|jun|jul)') OR
  regexp_matches(trim(ht), '^(?i:may|jun|jul)[-/]\d{1,2}$') OR
  regexp_matches(trim(ht), '^[4-8]$') OR
  (regexp_matches(trim(ht), '^\d{2,3}$') AND TRY_CAST(trim(ht) AS INTEGER) BETWEEN 50 AND 110))
ORDER BY ht LIMIT 10"""))
def _(spark, sf):
    h = height_table(spark, sf)
    return shape.rejected_values(h.withColumn("parsed", height_inches("ht")), "ht", "parsed")


@check("B10_label_text", on_cohort(
    "SELECT id, CASE label WHEN 1 THEN 'Yes' ELSE 'No' END AS drafted FROM cohort"))
def _(spark, sf):
    return order_cohort(spark, sf).select("id", shape.label_text("label").alias("drafted"))


@check("B11_membership", on_cohort("""
SELECT id, segment FROM cohort WHERE segment IN ('BUILDING', 'MACHINERY')"""))
def _(spark, sf):
    c = order_cohort(spark, sf)
    return c.where(F.col("segment").isin("BUILDING", "MACHINERY")).select("id", "segment")


@check("B12_points", on_cohort("""
SELECT label, qty, price, n_lines FROM cohort
WHERE qty IS NOT NULL AND price IS NOT NULL AND n_lines IS NOT NULL"""))
def _(spark, sf):
    return shape.points(order_cohort(spark, sf), "label", "qty", "price", "n_lines")


@check("B13_preview", on_cohort("SELECT id, label, qty FROM cohort ORDER BY id LIMIT 5"))
def _(spark, sf):
    return shape.preview(order_cohort(spark, sf).select("id", "label", "qty"), ["id"])


@check("B13_shape", on_cohort(
    "SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns FROM cohort"))
def _(spark, sf):
    return shape.table_shape(order_cohort(spark, sf).select("id", "label", "qty"))


@check("B13_info", on_cohort("""
SELECT * FROM (
  SELECT 0 AS position, 'id' AS "column", 'bigint' AS "type", count(id) AS non_null FROM cohort
  UNION ALL SELECT 1, 'segment', 'string', count(segment) FROM cohort
  UNION ALL SELECT 2, 'qty', 'double', count(qty) FROM cohort)"""))
def _(spark, sf):
    return shape.table_info(order_cohort(spark, sf).select("id", "segment", "qty"))


@check("C1_append_columns", on_cohort("""
SELECT id, qty, CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS seg_building,
       CASE WHEN segment = 'MACHINERY' THEN 1 ELSE 0 END AS seg_machinery FROM cohort"""))
def _(spark, sf):
    c = order_cohort(spark, sf)
    return c.select("id", "qty", *[
        F.coalesce(F.col("segment") == s, F.lit(False)).cast("int").alias(f"seg_{s.lower()}")
        for s in ("BUILDING", "MACHINERY")])


@check("C2_predictions_with_ids", on_cohort("""
SELECT id, score, CAST(score > 0.5::DOUBLE AS INTEGER) AS pred FROM cohort"""))
def _(spark, sf):
    return add_prediction(order_cohort(spark, sf).select("id", "score"))


@check("C3_train_values_on_all_rows", on_cohort("""
, train AS (SELECT * FROM cohort WHERE id % 5 <> 0),
lim AS (SELECT quantile_cont(qty, 0.7) AS q FROM train),
freq AS (SELECT n_lines, count(*) AS n FROM train WHERE n_lines IS NOT NULL GROUP BY 1),
top AS (SELECT n_lines AS m FROM freq ORDER BY n DESC, n_lines LIMIT 1)
SELECT id, coalesce(n_lines, m) AS n_lines,
       CASE WHEN qty > q THEN 1 ELSE 0 END AS big FROM cohort, lim, top"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "qty", "n_lines")
    train = c.where(F.col("id") % 5 != 0)
    recipe = [all_above("big", quantile={"qty": 0.7})]
    flagged = apply_recipe(c, recipe, fit_thresholds(train, recipe))
    return apply_fill(flagged, fit_modes(train, columns=["n_lines"])).select(
        "id", "n_lines", "big")


@check("H1_distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem""")
def _(spark, sf):
    return shape.distinct_rows(table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


@check("H2_append", on_cohort("SELECT id, label FROM cohort"))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "label")
    val = c.where(F.col("id") % 5 <= 1).select("label", "id")
    return shape.append(c.where(F.col("id") % 5 > 1), val)


@check("H3_shared_domain", on_cohort("""
SELECT DISTINCT 'segment' AS "column", segment AS value FROM cohort WHERE segment IS NOT NULL
UNION ALL SELECT DISTINCT 'grp', grp FROM cohort WHERE grp IS NOT NULL"""))
def _(spark, sf):
    c = order_cohort(spark, sf).select("id", "segment", "grp")
    parts = [c.where(F.col("id") % 3 == i) for i in range(3)]
    return shape.shared_domain(parts, ["segment", "grp"])
