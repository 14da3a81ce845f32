"""Every operator as a runnable query over the given tables, with its SQL twin."""

from __future__ import annotations

from . import (  # noqa: F401
    cohorts, derived, learning, models, preparation, ranks, scoring, shape, sources,
)
from .registry import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
