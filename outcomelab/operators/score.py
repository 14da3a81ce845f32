"""Scores and decisions.  Ids and labels travel with the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import flag, number, weighted_sum


def decide(score: str | Column, threshold: float = 0.5) -> Column:
    """1 when the score is strictly above the threshold."""
    c = F.col(score) if isinstance(score, str) else score
    return flag(c > F.lit(float(threshold)))


def add_prediction(df: DataFrame, score: str = "score", threshold: float = 0.5,
                   out: str = "pred") -> DataFrame:
    return df.withColumn(out, decide(score, threshold))


def score_with(model, df: DataFrame, keep: Sequence[str], threshold: float = 0.5,
               score: str = "score") -> DataFrame:
    """``keep`` columns plus the positive-class probability and the decision.

    The model's own argmax prediction is ignored in favour of the strict rule.
    """
    scored = model.transform(df).withColumn(score, vector_to_array("probability")[1])
    return add_prediction(scored.select(*keep, score), score, threshold)


METHODS = ("proba_averaging", "voting")


def ensemble(df: DataFrame, scores: Sequence[str], weights: Sequence[float] | None = None,
             method: str = "proba_averaging", threshold: float = 0.5,
             score: str = "score", pred: str = "pred") -> DataFrame:
    """Weighted mean of score columns, and a soft or hard decision.

    The hard vote is the weighted share of positive votes rounded half to even,
    so an even split is negative.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    weights = list(weights) if weights is not None else [1.0 / len(scores)] * len(scores)
    if len(weights) != len(scores):
        raise ValueError("one weight per score column is needed")
    scale = float(sum(weights))
    mean = weighted_sum(list(zip([number(s) for s in scores], weights))) / F.lit(scale)
    if method == "proba_averaging":
        vote = decide(mean, threshold)
    else:
        votes = [(decide(s, threshold).cast("double"), w) for s, w in zip(scores, weights)]
        vote = F.bround(weighted_sum(votes) / F.lit(scale), 0).cast("int")
    return df.withColumns({score: mean, pred: vote})


def submission(scored: DataFrame, id_column: str, score: str = "score",
               id_name: str = "id", value_name: str = "drafted") -> DataFrame:
    """The two-column table handed in for judging."""
    return scored.select(F.col(id_column).alias(id_name), F.col(score).alias(value_name))
