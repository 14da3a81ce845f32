"""Readers and sinks on files written by hand or by Spark."""

import math

import pytest
from pyspark.sql import functions as F

from outcomelab.session import cut_lineage
from outcomelab.sources import readers, writers


def test_csv_missing_markers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,x,k\n1,1.5,a\n2,,b\n3,NaN,\n4,NA,c\n")
    df = readers.read_csv(spark, str(path), "id int, x double, k string", null_value="NA")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 1.5, "a"), (2, None, "b"), (3, None, None), (4, None, "c")]
    inferred = readers.read_csv(spark, str(path))
    assert dict(inferred.dtypes)["id"] == "int"


def test_pair_names_every_missing_column(spark, tmp_path):
    (tmp_path / "train.csv").write_text("id,x\n1,2\n")
    (tmp_path / "test.csv").write_text("id,x\n1,2\n")
    with pytest.raises(ValueError, match="training table is missing columns: k, drafted"):
        readers.read_pair(spark, str(tmp_path), required=["id", "k"], target="drafted")
    train, test = readers.read_pair(spark, str(tmp_path), required=["id"])
    assert train.count() == test.count() == 1


@pytest.mark.parametrize("encoding, expected", [
    ("utf-8", "UTF-8"), ("utf-8-sig", "UTF-8"), ("latin1", "ISO-8859-1")])
def test_encoding_detection(spark, tmp_path, encoding, expected):
    path = tmp_path / "t.csv"
    path.write_bytes("name,x\nJosé,1\nÅsa,2\n".encode(encoding))
    df, used = readers.read_csv_any_encoding(spark, str(path), "name string, x int")
    assert used == expected
    assert [r["name"] for r in df.orderBy("x").collect()] == ["José", "Åsa"]


def test_encoding_failure_is_reported(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b"name\n\xff\xfe\n")
    with pytest.raises(ValueError, match="decodes"):
        readers.detect_encoding(spark, str(path), ["UTF-8"])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_split_files(spark, tmp_path, fmt):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test"))
    path = str(tmp_path / "out")
    writers.write_splits(df, path, fmt=fmt)
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    train = getattr(reader, fmt)(f"{path}/split=train")
    assert train.count() == 7 and "split" not in train.columns
    with pytest.raises(ValueError, match="format"):
        writers.write_splits(df, path, fmt="xml")


def test_submission_file(spark, tmp_path):
    path = str(tmp_path / "submission")
    df = spark.createDataFrame([("p1", .25), ("p2", .75)], "player_id string, score double")
    writers.write_submission(df, path, "player_id")
    back = readers.read_csv(spark, path, "id string, drafted double")
    assert {tuple(r) for r in back.collect()} == {("p1", .25), ("p2", .75)}


def test_parquet_nan_becomes_null(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(math.nan,), (1.0,)], "x double").write.parquet(path)
    assert readers.read_parquet(spark, path).where("x IS NULL").count() == 1


def test_lineage_is_cut_in_the_named_folder(spark):
    df = cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5
    assert spark.sparkContext.getCheckpointDir() is not None
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
