"""Projections, filters and set operations on whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import flag, is_numeric, number

# Columns that identify a row or leak the outcome.
NON_FEATURES = ("id", "player_id", "player_name", "team", "pick", "drafted")


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> DataFrame:
    """Fail at plan time, naming every missing column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns: {', '.join(missing)}")
    return df


def missing_as_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def split_features_target(df: DataFrame, target: str,
                          also_drop: Sequence[str] = ("pick",)) -> DataFrame:
    """Features first, label last, in one table; the rows stay together."""
    require_columns(df, [target])
    features = [c for c in df.columns if c != target and c not in also_drop]
    return df.select(*features, target)


def feature_columns(df: DataFrame, target: str | None = None, exclude: Iterable[str] = (),
                    shared_with: DataFrame | None = None,
                    policy: Iterable[str] = NON_FEATURES) -> list[str]:
    """Names left after the drop policy, in table order."""
    dropped = {*policy, *exclude, *([target] if target else [])}
    kept = [c for c in df.columns if c not in dropped]
    if shared_with is not None:
        kept = [c for c in kept if c in shared_with.columns]
    return kept


def select_features(df: DataFrame, target: str | None = None, exclude: Iterable[str] = (),
                    shared_with: DataFrame | None = None,
                    policy: Iterable[str] = NON_FEATURES) -> DataFrame:
    return df.select(*feature_columns(df, target, exclude, shared_with, policy))


def promote_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Every numeric column as double."""
    skip = set(exclude)
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if is_numeric(f.dataType) and f.name not in skip else F.col(f.name)
        for f in df.schema.fields])


def define_target(df: DataFrame, target: str = "drafted", order_column: str = "pick") -> DataFrame:
    """Integer target: the existing column, else a positive pick, else unchanged."""
    if target in df.columns:
        return df.withColumn(target, F.col(target).cast("int"))
    if order_column in df.columns:
        return df.withColumn(target, flag(number(order_column) > 0))
    return df


def rows_of_class(df: DataFrame, label: str, value: int, not_null: Sequence[str] = ()) -> DataFrame:
    out = df.where(F.col(label) == value)
    return out.na.drop("any", subset=list(not_null)) if not_null else out


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns is not None else None)


def rejected_values(df: DataFrame, source: str, parsed: str, n: int = 10) -> DataFrame:
    """The first ``n`` distinct inputs that were given but could not be parsed."""
    return (df.where(F.col(source).isNotNull() & F.col(parsed).isNull())
            .select(source).distinct().orderBy(source).limit(n))


def label_text(label: str | Column, negative: str = "No", positive: str = "Yes") -> Column:
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c == 0, negative).when(c == 1, positive)


def points(df: DataFrame, label: str, x: str, y: str, size: str | None = None,
           fractions: Mapping[int, float] | None = None, seed: int = 42) -> DataFrame:
    """Complete ``(label, x, y[, size])`` rows; a sample per class only on request."""
    wanted = [label, x, y, *([size] if size else [])]
    out = df.select(*wanted).na.drop("any")
    return out.sampleBy(label, dict(fractions), seed) if fractions else out


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def table_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and non-null count, in one scan."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                      F.lit(f.dataType.simpleString()).alias("type"),
                      F.col(f"`{f.name}`").alias("non_null"))
             for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*pairs)))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def append(*parts: DataFrame) -> DataFrame:
    """Stack tables by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def shared_domain(parts: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Every ``(column, value)`` found in any of the tables, once."""
    stacked = append(*[p.select(*[F.col(c).cast("string").alias(c) for c in columns])
                       for p in parts])
    return (stacked.unpivot([], list(columns), "column", "value")
            .where(F.col("value").isNotNull()).distinct())
