"""Distribution tables per class: histogram, density, box summary, rank test."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import number
from .bins import equal_width_bin
from .ordering import quantiles, running_totals


def _class_ranges(df: DataFrame, column: str, label: str, classes: Sequence[int]) -> Column:
    """Count, range and spread of each class as one scalar subquery (an array by class)."""
    def stats(k: int) -> Column:
        x = F.when(F.col(label) == k, number(column))
        return F.struct(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                        F.stddev_samp(x).alias("std"))
    return df.agg(F.array(*[stats(k) for k in classes]).alias("r")).scalar()


def _with_ranges(df: DataFrame, column: str, label: str, classes: Sequence[int]) -> DataFrame:
    ranges = _class_ranges(df, column, label, classes)
    position = F.array_position(F.array(*[F.lit(k) for k in classes]), F.col(label)) - 1
    rows = df.where(F.col(label).isin(list(classes))).select(
        F.col(label).alias("class"), number(column).alias("x"),
        F.get(ranges, position.cast("int")).alias("r"))
    return rows.where(F.col("x").isNotNull())


def histogram(df: DataFrame, column: str, label: str, bins: int = 30,
              classes: Sequence[int] = (0, 1)) -> DataFrame:
    """``(class, bin, lo, hi, n, density)`` over each class's own range; last bin closed.

    Empty bins are left out.  The only shuffle is of classes x bins partial counts.
    """
    rows = _with_ranges(df, column, label, classes)
    lo, hi = F.col("r.lo"), F.col("r.hi")
    # A constant class gets a unit-wide range around its value.
    start = F.when(hi > lo, lo).otherwise(lo - 0.5)
    stop = F.when(hi > lo, hi).otherwise(hi + 0.5)
    binned = rows.select(
        "class", equal_width_bin(F.col("x"), start, stop, bins, right_closed=False).alias("bin"),
        start.alias("start"), ((stop - start) / bins).alias("step"), F.col("r.n").alias("size"))
    return (binned.groupBy("class", "bin", "start", "step", "size")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("class", "bin",
                    (F.col("start") + F.col("step") * (F.col("bin") - 1)).alias("lo"),
                    (F.col("start") + F.col("step") * F.col("bin")).alias("hi"),
                    "n", (F.col("n") / (F.col("size") * F.col("step"))).alias("density")))


def density(df: DataFrame, column: str, label: str, grid: int = 200, bins: int = 512,
            classes: Sequence[int] = (0, 1), margin: float = 0.5) -> DataFrame:
    """Gaussian kernel density ``(class, step, x, density)`` with Scott's bandwidth.

    Rows are first counted in ``bins`` fine bins per class (their centres stand
    for the values), so the kernel sum costs bins x grid terms whatever the table
    size.  The grid spans the class range widened by ``margin`` times its width.
    """
    rows = _with_ranges(df, column, label, classes)
    rows = rows.where(F.col("r.hi") > F.col("r.lo"))
    lo, hi = F.col("r.lo"), F.col("r.hi")
    binned = (rows.select("class", "r", equal_width_bin(
        F.col("x"), lo, hi, bins, right_closed=False).alias("bin"))
        .groupBy("class", "r", "bin").agg(F.count(F.lit(1)).alias("n")))
    width = hi - lo
    first = lo - width * margin
    step = width * (1 + 2 * margin) / (grid - 1)
    spread = binned.select(
        "class", F.col("r.n").alias("size"), "n",
        (lo + width / bins * (F.col("bin") - 0.5)).alias("centre"),
        (F.col("r.std") * F.pow(F.col("r.n").cast("double"), F.lit(-0.2))).alias("bandwidth"),
        first.alias("first"), step.alias("delta"),
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("step"))
    at = F.col("first") + F.col("delta") * F.col("step")
    z = (at - F.col("centre")) / F.col("bandwidth")
    scale = F.col("size") * F.col("bandwidth") * F.lit(math.sqrt(2 * math.pi))
    return (spread.select("class", "step", at.alias("x"),
                          (F.col("n") * F.exp(-z * z / 2) / scale).alias("term"))
            .groupBy("class", "step", "x").agg(F.sum("term").alias("density")))


def box_summary(df: DataFrame, column: str, by: str,
                groups: Sequence[object] | None = None) -> DataFrame:
    """Box-plot numbers per group: mean, quartiles, whiskers, outliers, notch, range.

    Whiskers are the most extreme values within 1.5 interquartile ranges.  The
    quartiles are fitted exactly first; everything else is one aggregation.
    """
    rows = df.select(F.col(by), number(column).alias("x")).where(F.col(by).isNotNull())
    if groups is not None:
        rows = rows.where(F.col(by).isin(list(groups)))
    found = quantiles(rows, ["x"], [0.25, 0.5, 0.75], by=by)
    quartiles = F.lit(None).cast("struct<q1:double,median:double,q3:double>")
    for (group, _), (q1, q2, q3) in found.items():
        if q1 is not None:
            quartiles = F.when(F.col(by) == F.lit(group), F.struct(
                F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"))
            ).otherwise(quartiles)
    x = F.col("x")
    boxed = rows.select(by, "x", quartiles.alias("q")).where(x.isNotNull())
    spread = F.col("q.q3") - F.col("q.q1")
    low, high = F.col("q.q1") - 1.5 * spread, F.col("q.q3") + 1.5 * spread
    notch = 1.57 * spread / F.sqrt(F.col("n"))
    return (boxed.groupBy(by, "q").agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.min(F.when(x >= low, x)).alias("whisker_low"),
        F.max(F.when(x <= high, x)).alias("whisker_high"),
        F.count_if((x < low) | (x > high)).alias("outliers"))
        .select(by, "n", "mean", "min", "max", F.col("q.q1").alias("q1"),
                F.col("q.median").alias("median"), F.col("q.q3").alias("q3"),
                # A whisker never ends inside the box.
                F.least("whisker_low", "q.q1").alias("whisker_low"),
                F.greatest("whisker_high", "q.q3").alias("whisker_high"),
                "outliers", (F.col("q.median") - notch).alias("notch_low"),
                (F.col("q.median") + notch).alias("notch_high")))


def top_categories(df: DataFrame, key: str, n: int = 5) -> list[str]:
    """The ``n`` most frequent categories; equal counts are ordered by name."""
    counted = (df.where(F.col(key).isNotNull()).groupBy(key)
               .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(n))
    return [r[key] for r in counted.collect()]


def box_by_top_categories(df: DataFrame, column: str, key: str, n: int = 5) -> DataFrame:
    return box_summary(df, column, key, top_categories(df, key, n))


def rank_sum_u(df: DataFrame, column: str, label: str) -> DataFrame:
    """One row: sizes of both classes, U of class 0, and the tie term Σ(t³ − t).

    Works on distinct values with class counts; no row is ever ranked on its own.
    """
    y = F.col(label)
    totals = running_totals(df.where(y.isin(0, 1)), column, {
        "n0": (y == 0).cast("bigint"), "n1": (y == 1).cast("bigint")})
    t = (F.col("n0") + F.col("n1")).cast("double")
    return totals.agg(
        F.max("n0_total").alias("n_0"), F.max("n1_total").alias("n_1"),
        F.sum(F.col("n0") * (F.col("n1_before") + F.col("n1") / 2)).alias("u"),
        F.sum(t * t * t - t).alias("ties"))


#: A side of at most so many rows has an exact test, up to so many pairs of rows.
EXACT_SIDE, EXACT_PAIRS = 8, 1_000_000


def rank_sum_counts(m: int, n: int) -> list[int]:
    """How many orders of ``m`` and ``n`` rows give each U, from 0 to ``m * n``.

    The counts for ``i`` and ``n`` rows follow from those for ``i - 1``: U's generating
    function gains the factor ``(1 - q^(n + i)) / (1 - q^i)``.
    """
    m, n = min(m, n), max(m, n)
    counts = [1] + [0] * (m * n)
    for i in range(1, m + 1):
        for u in range(m * n, n + i - 1, -1):
            counts[u] -= counts[u - n - i]
        for u in range(i, m * n + 1):
            counts[u] += counts[u - i]
    return counts


def exact_rank_sum_p(u: float, n0: int, n1: int) -> float:
    """Two-sided probability of a U at least as far from its middle, without ties."""
    counts = rank_sum_counts(n0, n1)
    far = int(max(u, n0 * n1 - u))
    return min(1.0, 2 * sum(counts[far:]) / sum(counts))


def rank_sum_test(df: DataFrame, column: str, label: str, alpha: float = 0.05) -> DataFrame:
    """Two-sided Mann-Whitney test: ``(n_0, n_1, u, z, p_value, significant)``.

    Exact where there are no ties, a side has at most ``EXACT_SIDE`` rows and there are at
    most ``EXACT_PAIRS`` pairs; else the normal approximation with tie and continuity
    correction.  ``z`` is that of the approximation in both cases.
    """
    row = rank_sum_u(df, column, label).first()
    n0, n1, u, ties = row["n_0"] or 0, row["n_1"] or 0, row["u"], row["ties"]
    z = p = None
    n = n0 + n1
    if n0 and n1:
        variance = n0 * n1 / 12 * (n + 1 - ties / (n * (n - 1)))
        if variance > 0:
            z = max(0.0, abs(u - n0 * n1 / 2) - 0.5) / math.sqrt(variance)
            exact = not ties and min(n0, n1) <= EXACT_SIDE and n0 * n1 <= EXACT_PAIRS
            p = exact_rank_sum_p(u, n0, n1) if exact else math.erfc(z / math.sqrt(2))
        else:
            z, p = 0.0, 1.0
    return df.sparkSession.createDataFrame(
        [(n0, n1, None if u is None else float(u), z, p, None if p is None else p < alpha)],
        "n_0 bigint, n_1 bigint, u double, z double, p_value double, significant boolean")
