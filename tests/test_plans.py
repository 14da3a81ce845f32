"""Plan shapes that must hold at any table size."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import catalog
from outcomelab.operators import bins, cohort, decide, dist, evaluate, prep
from outcomelab.operators.ordering import ranked_rows, running_totals
from outcomelab.plans.order_cohort import order_cohort, table


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cohort_table(spark, folder):
    return order_cohort(spark, folder)


def test_scan_is_pruned_and_filtered(spark, folder):
    lines = table(spark, folder, "lineitem").where(F.col("l_quantity") > 10)
    plan = physical(cohort.group_rate(
        lines.select("l_shipdate", "l_partkey", (F.col("l_returnflag") == "R").cast("int")
                     .alias("y")), "l_partkey", "y"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)" in plan
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string>",
                     plan)


def test_no_python_in_any_query_plan(spark, folder):
    names = ["D2_height_month_is_feet", "D19_whole_recipe", "F14_equal_width_rate",
             "J8_roc_points", "I6_rare_levels", "I10_split_60_20_20"]
    for name in names:
        plan = physical(catalog.queries()[name](spark, folder))
        assert "Python" not in plan and "Pandas" not in plan, name


def test_no_cross_join_anywhere(spark, folder):
    for name, query in catalog.queries().items():
        if name[0] in "AK" or name.startswith("J2"):
            continue                      # these run jobs rather than build one plan
        plan = optimized(query(spark, folder))
        assert "Join Cross" not in plan and not re.search(r"Join Inner\s*$", plan, re.M), name


@pytest.mark.parametrize("build", [
    lambda c: running_totals(c, "score", {"n": F.lit(1)}),
    lambda c: evaluate.roc_points(c, "label", "score"),
    lambda c: ranked_rows(c.select("id", "score"), "score", "id"),
])
def test_one_task_only_ever_sees_combined_rows(cohort_table, build):
    lines = physical(build(cohort_table)).splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single
    for i in single:
        assert "HashAggregate(keys=[__bucket" in lines[i + 1], lines[i + 1]


def test_rates_are_combined_before_the_shuffle(cohort_table):
    plan = physical(cohort.group_rate(cohort_table, "grp", "label"))
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(grp")


def test_one_pass_for_many_statistics(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("y", (F.col("l_tax") > .04).cast("int"))
    for df in (cohort.class_means(lines, ["l_quantity", "l_discount", "l_extendedprice"], "y"),
               decide.threshold_table(lines, "y", "l_discount"),
               evaluate.classification_report(lines.withColumn("p", F.lit(1)), "y", "p")):
        assert physical(df).count("FileScan") == 1


def test_ranges_are_scalar_subqueries(cohort_table):
    for df in (bins.equal_width_rate(cohort_table, "balance", "label"),
               dist.histogram(cohort_table, "balance", "label"),
               prep.class_weights(cohort_table, "label")):
        assert "scalar-subquery" in optimized(df)
        assert "BroadcastNestedLoopJoin" not in physical(df)


def test_entry_and_registry(spark):
    out = entry_module.entry(spark)
    assert out.columns == ["grp", "positives", "n", "rate"] and out.count() == 20
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(entry_module.queries()) > 100
