"""Outcome rates and statistics per cohort.

``label`` is a 0/1 column.  Both classes are always measured in the same pass
with conditional aggregates; a missing group key is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import number, numbers
from .ordering import quantiles


def _positives(label: str) -> Column:
    return F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0).cast("bigint"))


def group_rate(df: DataFrame, key: str, label: str, order: str = "rate",
               top: int | None = None, positives_only: bool = False,
               digits: int | None = None) -> DataFrame:
    """``(key, positives, n, rate)`` ordered by ``rate`` or ``positives``, best first."""
    rate = F.avg(label)
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
           .agg(_positives(label).alias("positives"), F.count(label).alias("n"),
                (F.bround(rate, digits) if digits is not None else rate).alias("rate")))
    if positives_only:
        out = out.where(F.col("positives") > 0)
    out = out.orderBy(F.desc_nulls_last(order), key)
    return out.limit(top) if top else out


def flag_rates(df: DataFrame, flags: Sequence[str], label: str,
               neither: str | None = "neither") -> DataFrame:
    """``(group, n, rate)`` for each flag set, and for the rows with no flag set."""
    tests = {f: F.col(f) == 1 for f in flags}
    if neither:
        tests[neither] = reduce(lambda a, b: a & b, [F.col(f) == 0 for f in flags])
    names = list(tests)
    stats = df.agg(*[F.struct(
        F.lit(name).alias("group"),
        F.count(F.when(tests[name], F.col(label))).alias("n"),
        F.avg(F.when(tests[name], F.col(label))).alias("rate")).alias(name) for name in names])
    return stats.select(F.inline(F.array(*[F.col(f"`{n}`") for n in names])))


def rate_by_flag(df: DataFrame, flag: str, label: str) -> DataFrame:
    return (df.where(F.col(flag).isNotNull()).groupBy(flag)
            .agg(F.count(label).alias("n"), F.avg(label).alias("rate")).orderBy(flag))


def rate_lift(df: DataFrame, flag: str, label: str, zero_rate: float = 0.001) -> DataFrame:
    """One row: both rates and their ratio.

    A table without any row outside the flag is compared with ``zero_rate``.
    """
    y = F.col(label)
    inside = F.coalesce(F.avg(F.when(F.col(flag) == 1, y)), F.lit(0.0))
    outside = F.avg(F.when(F.col(flag) == 0, y))
    rates = df.agg(inside.alias("rate_in"), outside.alias("rate_out"))
    return rates.select(
        "rate_in", "rate_out",
        F.try_divide("rate_in", F.coalesce("rate_out", F.lit(zero_rate))).alias("lift"))


def crosstab(df: DataFrame, key: str, label: str) -> DataFrame:
    """``(key, n_0, n_1, total, positive_pct)`` with zeros for absent pairs."""
    zero, one = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
           .agg(zero.alias("n_0"), one.alias("n_1"), F.count(label).alias("total")))
    return out.select("*", F.coalesce(
        F.try_divide(F.col("n_1"), F.col("total")) * 100, F.lit(0.0)).alias("positive_pct"))


def class_means(df: DataFrame, columns: Sequence[str], label: str,
                scaled: bool = False) -> DataFrame:
    """``(column, mean_0, mean_1[, scaled_0, scaled_1])``, all columns in one pass.

    The scaled form divides by the larger class mean when that is positive.
    """
    y = F.col(label)
    means = numbers(df, columns, [label]).agg(*[F.struct(
        F.lit(c).alias("column"),
        F.avg(F.when(y == 0, F.col(c))).alias("mean_0"),
        F.avg(F.when(y == 1, F.col(c))).alias("mean_1")).alias(c) for c in columns])
    out = means.select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))
    if scaled:
        larger = F.greatest("mean_0", "mean_1")
        base = F.when(larger > 0, larger).otherwise(F.lit(1.0))
        out = out.select("*", (F.col("mean_0") / base).alias("scaled_0"),
                         (F.col("mean_1") / base).alias("scaled_1"))
    return out


def class_summary(df: DataFrame, column: str, label: str) -> DataFrame:
    """``(stat, value_0, value_1, difference)`` for mean, median, std, min and max.

    The difference (class 1 minus class 0) is given for the mean and the median.
    """
    x, y = number(column), F.col(label)
    medians = quantiles(df.where(y.isin(0, 1)), [column], [0.5], by=label)
    aggregates = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    stats = df.agg(*[f(F.when(y == k, x)).alias(f"{name}_{k}")
                     for name, f in aggregates.items() for k in (0, 1)])
    rows = []
    for name in ("mean", "median", "std", "min", "max"):
        if name == "median":
            pair = [F.lit(medians.get((k, column), [None])[0]).cast("double") for k in (0, 1)]
        else:
            pair = [F.col(f"{name}_{k}") for k in (0, 1)]
        gap = pair[1] - pair[0] if name in ("mean", "median") else F.lit(None).cast("double")
        rows.append(F.struct(F.lit(name).alias("stat"), pair[0].alias("value_0"),
                             pair[1].alias("value_1"), gap.alias("difference")))
    return stats.select(F.inline(F.array(*rows)))


PERCENTILES = (25, 50, 75, 90, 95, 99)


def class_percentiles(df: DataFrame, column: str, label: str,
                      percents: Sequence[int] = PERCENTILES) -> DataFrame:
    """``(percent, value_0, value_1)``, exact."""
    found = quantiles(df.where(F.col(label).isin(0, 1)), [column],
                      [p / 100 for p in percents], by=label)
    missing = [None] * len(percents)
    rows = list(zip(percents, found.get((0, column), missing), found.get((1, column), missing)))
    return df.sparkSession.createDataFrame(
        rows, "percent int, value_0 double, value_1 double")
