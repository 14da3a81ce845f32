"""Column profiles and simple counts, each in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import numbers
from .ordering import quantiles


def column_profile(df: DataFrame, columns: Sequence[str] | None = None,
                   distinct: str = "exact", only_missing: bool = False) -> DataFrame:
    """Per column: type, kind, non-null and null counts, null percentage, distinct values.

    All counts come from a single aggregation.  ``distinct="approx"`` replaces the
    exact distinct counts by sketches, ``"skip"`` leaves them out; either avoids
    the shuffle of distinct values.
    """
    columns = list(columns or df.columns)
    fields = {f.name: f for f in df.schema.fields}
    exprs = [F.count(F.lit(1)).alias("__n")]
    for c in columns:
        exprs.append(F.count(c).alias(f"n_{c}"))
        if distinct == "exact":
            exprs.append(F.count_distinct(c).alias(f"d_{c}"))
        elif distinct == "approx":
            exprs.append(F.approx_count_distinct(c).alias(f"d_{c}"))
    counts = df.agg(*exprs)
    rows = []
    for c in columns:
        kind = "categorical" if fields[c].dataType.typeName() == "string" else "numeric"
        nulls = F.col("__n") - F.col(f"n_{c}")
        rows.append(F.struct(
            F.lit(c).alias("column"),
            F.lit(fields[c].dataType.simpleString()).alias("type"),
            F.lit(kind).alias("kind"),
            F.col(f"n_{c}").alias("non_null"),
            nulls.alias("nulls"),
            (F.try_divide(nulls, F.col("__n")) * 100).alias("null_pct"),
            *([] if distinct == "skip" else [F.col(f"d_{c}").alias("distinct")]),
        ))
    out = counts.select(F.inline(F.array(*rows)))
    if only_missing:
        out = out.where(F.col("nulls") > 0).orderBy(F.desc("nulls"), "column")
    return out


def column_kinds(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric-like and text column names, from the schema alone."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return [c for c in df.columns if c not in text], text


def value_counts(df: DataFrame, key: str, order: str = "count") -> DataFrame:
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), key) if order == "count" else counted.orderBy(key)


def overall_rate(df: DataFrame, label: str) -> DataFrame:
    y = F.col(label)
    return df.agg(
        F.coalesce(F.sum(y.cast("bigint")), F.lit(0).cast("bigint")).alias("positives"),
        F.count(y).alias("n"),
        F.avg(y).alias("rate"),
    )


def describe(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """``(group, column, n, mean, std, min, q25, q50, q75, max)`` in long form.

    Quartiles are exact; they are fitted first and attached as literals, so the
    moments stay a plain map-side-combined aggregation.
    """
    found = quantiles(df, columns, [0.25, 0.5, 0.75], by)
    keys = [by] if by else []
    exprs = []
    for c in columns:
        x = F.col(c)
        exprs.append(F.struct(
            F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max")).alias(c))
    rows = numbers(df, columns, keys)
    if by:
        rows = rows.where(F.col(by).isNotNull())
    moments = rows.groupBy(*keys).agg(*exprs)
    parts = []
    for c in columns:
        stats = F.col(c)
        parts.append(F.struct(
            F.lit(c).alias("column"),
            *[stats.getField(s).alias(s) for s in ("n", "mean", "std", "min")],
            *[_by_group(by, found, c, i).alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
            stats.getField("max").alias("max"),
        ))
    return moments.select(*keys, F.inline(F.array(*parts)))


def _by_group(by: str | None, found: dict, column: str, index: int) -> Column:
    """The fitted quantile as a literal, chosen by the group column."""
    out = F.lit(None).cast("double")
    if by is None:
        value = found[(None, column)][index]
        return out if value is None else F.lit(value)
    for (group, c), values in found.items():
        if c == column and values[index] is not None:
            out = F.when(F.col(by) == F.lit(group), F.lit(values[index])).otherwise(out)
    return out

