"""Small column-expression builders.  NULL is the only missing marker."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING_TEXT = "missing"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def number(c: str | Column) -> Column:
    """The value as a double, with NaN turned into NULL."""
    value = as_col(c).cast("double")
    return F.when(~F.isnan(value), value)


def numbers(df: DataFrame, columns: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Only the wanted columns, numeric ones cleaned once for everything that follows."""
    kept = list(dict.fromkeys(keep))
    return df.select(*kept, *[number(c).alias(c) for c in dict.fromkeys(columns)
                              if c not in kept])


def flag(condition: Column) -> Column:
    """0/1 integer that is never NULL: an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def weighted_sum(weights: Mapping[str, float] | list[tuple[Column, float]]) -> Column:
    """Sum of column times weight; NULL when any term is NULL."""
    pairs = weights.items() if isinstance(weights, Mapping) else weights
    return reduce(add, [as_col(c) * F.lit(float(w)) for c, w in pairs])


def guarded_ratio(num: str | Column, den: str | Column, guard: float) -> Column:
    """``num / (den + guard)``, NULL when the guarded denominator is zero."""
    return F.try_divide(as_col(num), as_col(den) + F.lit(float(guard)))


def filled_category(c: str | Column, text: str = MISSING_TEXT) -> Column:
    """The category as text, with NULL replaced by an explicit level."""
    return F.coalesce(as_col(c).cast("string"), F.lit(text))


def parse_number(c: str | Column) -> Column:
    """Text to double; NULL when the text is not a number."""
    return number(as_col(c).try_cast("double"))


def ordinal(c: str | Column, levels: Mapping[str, int]) -> Column:
    """Look a level up in a fixed order; anything else becomes NULL."""
    pairs = [F.lit(x) for item in levels.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), as_col(c)).cast("double")


def literal_array(values: Iterable[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def right_closed_bin(c: str | Column, edges: list[float]) -> Column:
    """1-based bin of ``(edges[i-1], edges[i]]``; NULL outside all bins.

    The edges are driver-side literals, so the ladder stays inside generated code.
    """
    value = as_col(c)
    ladder = F.when(value <= F.lit(float(edges[0])), F.lit(None).cast("int"))
    for i, hi in enumerate(edges[1:], start=1):
        ladder = ladder.when(value <= F.lit(float(hi)), F.lit(i))
    return ladder
