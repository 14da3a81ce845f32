"""Outcome rate by bins of a number.  Bins are closed on the right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import number, right_closed_bin
from .ordering import quantiles


def range_of(df: DataFrame, column: str) -> Column:
    """Minimum and maximum as one scalar subquery with fields ``lo`` and ``hi``."""
    x = number(column)
    return df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("r")).scalar()


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int,
                    right_closed: bool = True) -> Column:
    """1-based bin among ``bins`` equal steps from ``lo`` to ``hi``, both included.

    An estimate from one division is corrected against the two neighbouring
    edges, so values that sit on an edge land where comparing with every edge
    would put them.  A constant column falls in the middle bin.
    """
    step = (hi - lo) / F.lit(bins)
    position = F.try_divide(x - lo, hi - lo) * F.lit(bins)
    if right_closed:
        guess = F.ceil(position)
        guess = F.greatest(F.lit(1), F.least(F.lit(bins), guess))
        fixed = (F.when((guess > 1) & (x <= lo + step * (guess - 1)), guess - 1)
                 .when((guess < bins) & (x > lo + step * guess), guess + 1).otherwise(guess))
    else:
        guess = F.floor(position) + 1
        guess = F.greatest(F.lit(1), F.least(F.lit(bins), guess))
        fixed = (F.when((guess > 1) & (x < lo + step * (guess - 1)), guess - 1)
                 .when((guess < bins) & (x >= lo + step * guess), guess + 1).otherwise(guess))
    middle = (bins + 1) // 2 if right_closed else bins // 2 + 1
    # A missing value has no bin; ``least`` and ``greatest`` would skip it.
    return F.when(x.isNull(), F.lit(None)).when(hi > lo, fixed).otherwise(F.lit(middle)).cast("int")


def _rates(binned: DataFrame, label: str, *edges: Column) -> DataFrame:
    return (binned.where(F.col("bin").isNotNull()).groupBy("bin", *edges)
            .agg(F.count(label).alias("n"), F.avg(label).alias("rate")))


def equal_width_rate(df: DataFrame, column: str, label: str, bins: int = 10) -> DataFrame:
    """``(bin, lo, hi, n, rate)`` over ``bins`` equal steps of the column's range.

    The range is a scalar subquery over the same table; no row is shuffled before
    the per-bin counts.  Empty bins are left out.
    """
    bounds = range_of(df, column)
    rows = df.select(number(column).alias("x"), F.col(label), bounds.alias("r"))
    lo, hi = F.col("r.lo"), F.col("r.hi")
    binned = rows.select(label, equal_width_bin(F.col("x"), lo, hi, bins).alias("bin"), "r")
    width = (hi - lo) / bins
    return _rates(binned, label, F.col("r")).select(
        "bin", (lo + width * (F.col("bin") - 1)).alias("lo"),
        (lo + width * F.col("bin")).alias("hi"), "n", "rate")


def edge_rate(df: DataFrame, column: str, label: str, edges: Sequence[float]) -> DataFrame:
    """Rate by explicit edges; values outside the outermost edges are left out."""
    edges = [float(e) for e in edges]
    binned = df.select(label, right_closed_bin(number(column), edges).alias("bin"))
    lows, highs = F.array(*map(F.lit, edges[:-1])), F.array(*map(F.lit, edges[1:]))
    return _rates(binned, label).select(
        "bin", F.get(lows, F.col("bin") - 1).alias("lo"),
        F.get(highs, F.col("bin") - 1).alias("hi"), "n", "rate")


def quantile_edges(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Exact quantile edges per column with repeated edges dropped."""
    found = quantiles(df, columns, [i / bins for i in range(bins + 1)])
    return {c: sorted({v for v in found[(None, c)] if v is not None}) for c in columns}


def quantile_bin(c: str | Column, edges: Sequence[float]) -> Column:
    """1-based bin of ``(edge, next edge]``; the lowest edge belongs to the first bin."""
    x = F.col(c) if isinstance(c, str) else c
    if len(edges) < 2:
        return F.when(x.isNotNull(), F.lit(1))
    return F.when(x == F.lit(edges[0]), F.lit(1)).otherwise(right_closed_bin(x, list(edges)))


def quantile_rate(df: DataFrame, column: str, label: str, bins: int = 10) -> DataFrame:
    """Rate by equally filled bins; fewer bins come out when edges repeat."""
    edges = quantile_edges(df, [column], bins)[column]
    if len(edges) < 2:
        edges = edges * 2 or [0.0, 0.0]
    binned = df.select(label, quantile_bin(number(column), edges).alias("bin"))
    lows, highs = F.array(*map(F.lit, edges[:-1])), F.array(*map(F.lit, edges[1:]))
    return _rates(binned, label).select(
        "bin", F.get(lows, F.col("bin") - 1).alias("lo"),
        F.get(highs, F.col("bin") - 1).alias("hi"), "n", "rate")
