"""Cohort analytics and binary-outcome scoring as Spark DataFrame operators.

``sources``    readers and sinks
``functions``  column expressions
``operators``  DataFrame-in / DataFrame-out operators
``plans``      recipes, the order cohort, whole experiments
"""

from .session import build_session

__all__ = ["build_session"]
