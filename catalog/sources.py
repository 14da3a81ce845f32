"""A: sources and sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from outcomelab.operators.score import add_prediction
from outcomelab.operators.shape import require_columns
from outcomelab.operators.split import stratified_split
from outcomelab.plans.order_cohort import order_cohort, table
from outcomelab.sources.readers import (
    detect_encoding, read_csv, read_csv_any_encoding, read_pair, read_parquet,
)
from outcomelab.sources.writers import write_splits, write_submission

from .registry import check, rounded
from .sql import on_cohort


def scratch(spark: SparkSession) -> str:
    """A new folder: in the shared checkpoint folder of the cluster, else local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/outcomelab-{uuid.uuid4().hex}"
    return tempfile.mkdtemp(prefix="outcomelab-")


@check("A1_read_table", "SELECT * FROM customer")
def _(spark, sf):
    customers = read_parquet(spark, f"{sf}/customer.parquet")
    return require_columns(customers, ["c_custkey", "c_acctbal"], "customer table")


CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@check("A1_csv_declared_schema", """
SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment,
       c_acctbal FROM customer""")
def _(spark, sf):
    path = scratch(spark) + "/customer"
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path, CUSTOMER, null_value="MACHINERY").select(
        "c_custkey", "c_mktsegment", "c_acctbal")


@check("A1_train_test_pair", on_cohort("""
SELECT CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS part, count(*) AS n,
       count(qty) AS with_qty, round(sum(qty), 6) AS qty,
       CAST(sum(CASE WHEN id % 5 = 0 THEN 0 ELSE label END) AS BIGINT) AS positives
FROM cohort GROUP BY 1"""))
def _(spark, sf):
    folder = scratch(spark)
    c = order_cohort(spark, sf).select("id", "segment", "qty", "label")
    c.where(F.col("id") % 5 != 0).write.option("header", True).csv(f"{folder}/train.csv")
    c.where(F.col("id") % 5 == 0).drop("label").write.option("header", True).csv(
        f"{folder}/test.csv")
    schema = c.schema
    train, test = read_pair(spark, folder, schema, ["id", "qty"], target="label")

    def summary(df, part, label):
        return df.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"),
                      F.count("qty").alias("with_qty"), F.round(F.sum("qty"), 6).alias("qty"),
                      F.sum(label).cast("bigint").alias("positives"))
    return summary(train, "train", F.col("label")).unionByName(summary(test, "test", F.lit(0)))


@check("A2_encoding", """
SELECT 'ISO-8859-1' AS latin, 'UTF-8' AS utf, count(*) AS n,
       sum(length(c_name) + 1)::BIGINT AS chars FROM customer""")
def _(spark, sf):
    folder = scratch(spark)
    named = table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("é")).alias("c_name"))
    named.write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{folder}/latin")
    named.write.option("header", True).csv(f"{folder}/utf")
    back, encoding = read_csv_any_encoding(spark, f"{folder}/latin",
                                           "c_custkey bigint, c_name string")
    return back.agg(F.lit(encoding).alias("latin"),
                    F.lit(detect_encoding(spark, f"{folder}/utf")).alias("utf"),
                    F.count(F.lit(1)).alias("n"), F.sum(F.length("c_name")).alias("chars"))


@check("A3_split_files", on_cohort("""
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(id || '|42')) AS r,
         count(*) OVER (PARTITION BY label) AS n_class, count(*) OVER () AS n_all
  FROM cohort),
kept AS (SELECT label, any_value(n_class) AS n_class, any_value(n_all) AS n_all,
                any_value(n_all) - CAST(ceil(0.2::DOUBLE * any_value(n_all)) AS BIGINT) AS n_left
         FROM ranked GROUP BY label),
floors AS (SELECT *, n_left * n_class // n_all AS base, n_left * n_class % n_all AS rest FROM kept),
cuts AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                  <= n_left - sum(base) OVER () THEN 1 ELSE 0 END AS train_n FROM floors)
SELECT CASE WHEN r <= c.n_class - train_n THEN 'test' ELSE 'train' END AS split,
       count(*) AS n, round(sum(balance), 2) AS balance
FROM ranked JOIN cuts c USING (label) GROUP BY 1"""))
def _(spark, sf):
    path = scratch(spark) + "/splits"
    c = order_cohort(spark, sf).select("id", "label", "balance")
    write_splits(stratified_split(c, "label", "id", 0.2, seed=42), path)
    return spark.read.parquet(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 2).alias("balance"))


@check("A4_submission", on_cohort("SELECT id AS player_id, round(score, 6) AS drafted FROM cohort"))
def _(spark, sf):
    path = scratch(spark) + "/submission"
    write_submission(add_prediction(order_cohort(spark, sf)), path, "id", "score", "player_id")
    back = read_csv(spark, path, "player_id bigint, drafted double")
    return rounded(back, "drafted")
