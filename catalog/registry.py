"""Registry of runnable checks: a Spark query and, where possible, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its survey id; without SQL only its rows are checked."""
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query
    return register


def r6(c, name: str | None = None):
    """Round to six places, as both engines do before comparing sums of doubles."""
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column, 6).alias(name or (c if isinstance(c, str) else "value"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[r6(c) if c in columns else F.col(f"`{c}`") for c in df.columns])
