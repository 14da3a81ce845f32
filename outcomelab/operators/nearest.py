"""Mutual information of a number with a class by nearest neighbours.

For every value the distance to its k-th neighbour of the same class is held against the
number of rows of all classes within that distance.  Equal values of a class are one row
with a count.  Neighbours are looked up in range buckets, each with a halo of the ``k``
values before and after it, wherever those lie; counts within a distance are differences
of exact running totals at its two ends.  Nothing is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import number
from ..session import stored
from .ordering import BUCKET, default_buckets, running_totals, sketch_edges, with_bucket


def digamma(n: Column) -> Column:
    """The digamma function of a positive number: eight steps up, then its asymptotic series."""
    x = n.cast("double")
    z = x + 8
    series = (F.log(z) - 1 / (2 * z) - 1 / (12 * z * z) + 1 / (120 * F.pow(z, F.lit(4)))
              - 1 / (252 * F.pow(z, F.lit(6))) + 1 / (240 * F.pow(z, F.lit(8))))
    for j in range(8):
        series = series - 1 / (x + j)
    return series


def _with_halo(values: DataFrame, k: int) -> DataFrame:
    """``y, x, n, bucket, halo``: each class bucket and the ``k`` values on both sides of it."""
    asc, desc = (Window.partitionBy("y", BUCKET).orderBy(o("x")) for o in (F.asc, F.desc))
    # At most k rows a class and bucket in each of the two.
    low = values.withColumn("r", F.row_number().over(asc)).where(F.col("r") <= k)
    high = values.withColumn("r", F.row_number().over(desc)).where(F.col("r") <= k)
    ordered = Window.partitionBy("y").orderBy("x")
    pair = F.struct("x", "n")
    ends = Window.partitionBy("y", BUCKET)
    before = (high.withColumns({"near": F.collect_list(pair).over(ordered.rowsBetween(-k, -1)),
                                "first": F.min("x").over(ends)}).where("x = first"))
    after = (low.withColumns({"near": F.collect_list(pair).over(ordered.rowsBetween(1, k)),
                              "last": F.max("x").over(ends)}).where("x = last"))
    halo = before.select("y", BUCKET, "near").unionByName(after.select("y", BUCKET, "near")).select(
        "y", BUCKET, F.inline("near"), F.lit(True).alias("halo"))
    return values.select("y", BUCKET, "x", "n", F.lit(False).alias("halo")).unionByName(halo)


def _radii(values: DataFrame, k: int) -> DataFrame:
    """``y, x, n, size, k, r`` with the distance to the k-th other row of the class."""
    around = Window.partitionBy("y", BUCKET).orderBy("x").rowsBetween(-k, k)
    near = _with_halo(values, k).withColumn("near", F.collect_list(F.struct("x", "n")).over(around)).where("NOT halo")
    sizes = values.groupBy("y").agg(F.sum("n").alias("size"))
    # One row a class; any other join would bring all rows of a class to one task.
    near = near.join(F.broadcast(sizes), "y").withColumn("k", F.least(F.lit(k).cast("long"), F.col("size") - 1))
    others = F.flatten(F.transform("near", lambda s: F.array_repeat(
        F.abs(s["x"] - F.col("x")), F.least(F.when(s["x"] == F.col("x"), s["n"] - 1).otherwise(s["n"]),
                                            F.lit(k)).cast("int"))))
    return near.select("y", "x", "n", "size", "k",
                       F.element_at(F.array_sort(others), F.col("k").cast("int")).alias("r"))


def neighbour_information(df: DataFrame, columns: Sequence[str], label: str, k: int = 3,
                          top: int | None = 30, buckets: int | None = None) -> DataFrame:
    """``feature, mi`` (nats, 0 at least), best first; ``mi`` is null without two rows of a class.

    Rows with a missing value or class are left out per column, and so are classes with one
    row.  ``k`` shrinks to a class's size less one.  A row is within the distance ``r`` of
    ``x`` if it lies strictly between ``x - r`` and ``x + r``; where ``r`` is 0, at ``x``.
    """
    out = None
    # Read several times for every column, so made once for all of them.
    df = stored(df.select(*dict.fromkeys([*columns, label])))
    for c in columns:
        rows = df.select(number(c).alias("x"), F.col(label).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
        counted = rows.groupBy("y", "x").agg(F.count(F.lit(1)).alias("n"))
        sizes = counted.groupBy("y").agg(F.sum("n").alias("size")).where("size > 1").select("y")
        counted = counted.join(F.broadcast(sizes), "y", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
        edges, _ = sketch_edges(counted, "x", buckets or default_buckets(df))
        points = _radii(with_bucket(counted, "x", edges), k).withColumns(
            {"low": F.col("x") - F.col("r"), "high": F.col("x") + F.col("r")}).persist(StorageLevel.MEMORY_AND_DISK)
        at = lambda v, n: points.select(F.col(v).alias("v"), n.alias("points"))
        zero = F.lit(0).cast("long")
        events = at("x", F.col("n")).unionByName(at("low", zero)).unionByName(at("high", zero))
        totals = running_totals(events, "v", {"points": F.col("points")}, buckets=buckets)
        low = totals.select(F.col("v").alias("low"), "points_before", (F.col("points_before") + F.col("points")).alias("upto"))
        high = totals.select(F.col("v").alias("high"), F.col("points_before").alias("below"),
                             (F.col("points_before") + F.col("points")).alias("at_high"))
        within = F.when(F.col("r") > 0, F.col("below") - F.col("upto")).otherwise(F.col("at_high") - F.col("points_before"))
        n = F.col("n")
        mean = lambda value: F.sum(n * digamma(value)) / F.sum(n)
        one = points.join(low, "low").join(high, "high").agg(
            (digamma(F.sum(n)) + mean(F.col("k")) - mean(F.col("size")) - mean(within)).alias("mi")).select(
            F.lit(c).alias("feature"), F.when(F.col("mi").isNotNull(), F.greatest("mi", F.lit(0.0))).alias("mi"))
        out = one if out is None else out.unionByName(one)
    out = out.orderBy(F.desc_nulls_last("mi"), "feature")
    return out.limit(top) if top else out
