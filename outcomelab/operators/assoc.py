"""Association between columns, and between columns and the outcome."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import number, numbers, numeric_columns
from .bins import quantile_bin, quantile_edges

FEW_PAIRS = 10


def _safe_corr(a: str, b: str) -> Column:
    """Pearson correlation over complete pairs; NULL when either side is constant.

    The built-in ``corr`` fails on a constant column, hence the guarded quotient.
    """
    spread_a = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a)))
    spread_b = F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b)))
    return F.try_divide(F.covar_pop(a, b), spread_a * spread_b)


def target_correlations(df: DataFrame, label: str, columns: Sequence[str] | None = None,
                        exclude: Sequence[str] = (), top: int | None = 30) -> DataFrame:
    """``(feature, r, abs_r)`` ranked by strength; every column in one aggregation."""
    columns = list(columns or numeric_columns(df, {label, *exclude}))
    rows = numbers(df, [*columns, label])
    wide = rows.agg(*[_safe_corr(c, label).alias(c) for c in columns])
    out = (wide.unpivot([], columns, "feature", "r")
           .withColumn("abs_r", F.abs("r"))
           .orderBy(F.desc_nulls_last("abs_r"), "feature"))
    return out.limit(top) if top else out


def correlation_pairs(df: DataFrame, columns: Sequence[str],
                      min_r: float | None = None) -> DataFrame:
    """Lower triangle of the correlation matrix as ``(a, b, r)``, over complete pairs.

    A few pairs are single aggregate expressions.  A wide table would need
    thousands of them, so there the moments of all pairs come from one Gram
    matrix, whose size depends on the number of columns only.
    """
    pairs = list(combinations(columns, 2))
    if len(pairs) <= FEW_PAIRS:
        found = _aggregated_pairs(numbers(df, columns), pairs)
    else:
        rows = numbers(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = _matrix_pairs(rows, list(columns), pairs)
        finally:
            rows.unpersist()
    out = df.sparkSession.createDataFrame(
        [(a, b, found[(a, b)]) for a, b in pairs], "a string, b string, r double")
    return out.where(F.col("r") >= min_r) if min_r is not None else out


def _aggregated_pairs(rows: DataFrame, pairs: list[tuple[str, str]]
                      ) -> dict[tuple[str, str], float | None]:
    out: dict[tuple[str, str], float | None] = {}
    for start in range(0, len(pairs), FEW_PAIRS):
        part = pairs[start:start + FEW_PAIRS]
        row = rows.agg(*[_safe_corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(part)]).first()
        out.update({pair: row[f"p{i}"] for i, pair in enumerate(part)})
    return out


def _matrix_pairs(rows: DataFrame, columns: list[str], pairs: list[tuple[str, str]]
                  ) -> dict[tuple[str, str], float | None]:
    """Pair moments from the covariance of presence, value and squared value.

    Values are centred and scaled first, so nothing cancels.  Pairs in which a
    column hardly varies are measured again by a direct aggregate.
    """
    k = len(columns)
    first = rows.agg(F.count(F.lit(1)).alias("n"),
                     *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    if first["n"] < 2:
        return dict.fromkeys(pairs)
    scaled = rows.select(*[
        ((F.col(c) - F.lit(first[f"m{i}"] or 0.0)) / F.lit(first[f"s{i}"] or 1.0)).alias(f"z{i}")
        for i, c in enumerate(columns)])
    z = [F.col(f"z{i}") for i in range(k)]
    slots = [*[v.isNotNull().cast("double") for v in z],
             *[F.coalesce(v, F.lit(0.0)) for v in z],
             *[F.coalesce(v * v, F.lit(0.0)) for v in z]]
    vectors = scaled.select(array_to_vector(F.array(*slots)).alias("v"))
    stats = vectors.agg(Summarizer.metrics("count", "mean", "variance")
                        .summary(F.col("v")).alias("s")).first()["s"]
    n, mean, spread = stats["count"], stats["mean"].toArray(), stats["variance"].toArray() ** 0.5
    cov = Correlation.corr(vectors, "v").first()[0].toArray() * spread[:, None] * spread[None, :]
    moment = np.nan_to_num(cov) * (n - 1) / n + mean[:, None] * mean[None, :]

    out: dict[tuple[str, str], float | None] = {}
    again = []
    place = {c: i for i, c in enumerate(columns)}
    for a, b in pairs:
        i, j = place[a], place[b]
        w = moment[i, j]
        if w * n < 0.5 or not first[f"s{i}"] or not first[f"s{j}"]:
            out[(a, b)] = None                # never present together, or constant
            continue
        var_a = moment[2 * k + i, j] * w - moment[k + i, j] ** 2
        var_b = moment[2 * k + j, i] * w - moment[k + j, i] ** 2
        if min(var_a, var_b) < 1e-6 * w * w:
            again.append((a, b))
            continue
        joint = moment[k + i, k + j] * w - moment[k + i, j] * moment[k + j, i]
        out[(a, b)] = float(joint / (var_a * var_b) ** 0.5)
    out.update(_aggregated_pairs(rows, again))
    return out


def strongest_pairs(df: DataFrame, label: str, columns: Sequence[str], top: int) -> DataFrame:
    """Correlation pairs among the ``top`` columns that follow the label most closely."""
    names = [r["feature"] for r in
             target_correlations(df, label, columns, top=top).select("feature").collect()]
    return correlation_pairs(df, names)


def anova_f(df: DataFrame, columns: Sequence[str], label: str, classes: Sequence[int] = (0, 1),
            top: int | None = 30) -> DataFrame:
    """One-way F statistic per column from per-class counts, means and variances."""
    y, k = F.col(label), len(classes)
    exprs = []
    for i, c in enumerate(columns):
        for j in classes:
            x = F.when(y == j, F.col(c))
            exprs += [F.count(x).alias(f"n_{i}_{j}"), F.avg(x).alias(f"m_{i}_{j}"),
                      F.var_pop(x).alias(f"v_{i}_{j}")]
    stats = numbers(df, columns, [label]).agg(*exprs)
    rows = []
    for i, c in enumerate(columns):
        n = sum((F.col(f"n_{i}_{j}") for j in classes), F.lit(0))
        mean = F.try_divide(
            sum((F.col(f"n_{i}_{j}") * F.coalesce(f"m_{i}_{j}", F.lit(0.0)) for j in classes),
                F.lit(0.0)), n)
        between = sum((F.col(f"n_{i}_{j}") * F.pow(F.coalesce(f"m_{i}_{j}", mean) - mean, 2)
                       for j in classes), F.lit(0.0)) / F.lit(k - 1)
        within = F.try_divide(
            sum((F.col(f"n_{i}_{j}") * F.coalesce(f"v_{i}_{j}", F.lit(0.0)) for j in classes),
                F.lit(0.0)), n - F.lit(k))
        rows.append(F.struct(F.lit(c).alias("feature"), F.try_divide(between, within).alias("f")))
    out = stats.select(F.inline(F.array(*rows))).orderBy(F.desc_nulls_last("f"), "feature")
    return out.limit(top) if top else out


def mutual_information(df: DataFrame, columns: Sequence[str], label: str, bins: int = 10,
                       top: int | None = 30) -> DataFrame:
    """Mutual information (nats) of each quantile-binned column with the label.

    Joint counts per (feature, bin, label) are combined before the shuffle; after
    that every table has at most features x bins x classes rows.
    """
    edges = quantile_edges(df, columns, bins)
    binned = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("y"),
        *[quantile_bin(number(c), edges[c]).alias(c) for c in columns])
    joint = (binned.unpivot(["y"], list(columns), "feature", "bin")
             .where(F.col("bin").isNotNull())
             .groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("n")))

    def share_of(*keys: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*keys)) / F.sum("n").over(
            Window.partitionBy("feature"))

    cells = joint.select("feature", share_of("feature", "bin", "y").alias("p"),
                         (share_of("feature", "bin") * share_of("feature", "y")).alias("q"))
    out = (cells.groupBy("feature").agg(F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("mi"))
           .orderBy(F.desc("mi"), "feature"))
    return out.limit(top) if top else out


def keep_ranked(df: DataFrame, ranking: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The table reduced to the ranked features plus the columns to keep."""
    names = [r["feature"] for r in ranking.select("feature").collect()]
    return df.select(*dict.fromkeys([*keep, *names]))
