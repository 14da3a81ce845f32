"""Decision tables: thresholds, scenarios, net benefit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .evaluate import f1_of
from .ordering import top_rows

THRESHOLDS = (0.3, 0.5, 0.7, 0.9)
SCENARIOS = {"conservative": 0.7, "balanced": 0.5, "aggressive": 0.3}
INVITES = tuple(range(50, 551, 50))


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _counts_at(df: DataFrame, label: str, score: str, cuts: Sequence[float]) -> DataFrame:
    """One row per cut: predicted, correct, positives, total - all from one pass."""
    y, s = F.col(label) == 1, F.col(score)
    stats = df.agg(
        F.count_if(y).alias("positives"), F.count(F.lit(1)).alias("total"),
        *[F.count_if(s > F.lit(float(t))).alias(f"predicted_{i}") for i, t in enumerate(cuts)],
        *[F.count_if((s > F.lit(float(t))) & y).alias(f"correct_{i}")
          for i, t in enumerate(cuts)])
    return stats.select("positives", "total", F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(float(t)).alias("threshold"),
                 F.col(f"predicted_{i}").alias("predicted"),
                 F.col(f"correct_{i}").alias("correct")) for i, t in enumerate(cuts)])))


def threshold_table(df: DataFrame, label: str, score: str,
                    thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """``(pos, threshold, predicted, correct, precision, recall, f1, total, positives, rate)``."""
    t = _counts_at(df, label, score, thresholds)
    precision = _div(F.col("correct"), F.col("predicted"))
    recall = _div(F.col("correct"), F.col("positives"))
    return t.select("pos", "threshold", "predicted", "correct", precision.alias("precision"),
                    recall.alias("recall"), f1_of(precision, recall).alias("f1"),
                    "total", "positives",
                    F.try_divide(F.col("positives"), F.col("total")).alias("rate"))


def scenario_table(df: DataFrame, label: str, score: str,
                   scenarios: dict[str, float] = SCENARIOS) -> DataFrame:
    """``(scenario, threshold, selected, hits, hit_share, wasted, waste_share, missed)``.

    The waste share is NULL when nothing is selected.
    """
    t = _counts_at(df, label, score, list(scenarios.values()))
    name = F.get(F.array(*[F.lit(n) for n in scenarios]), F.col("pos"))
    wasted = F.col("predicted") - F.col("correct")
    return t.select(
        name.alias("scenario"), "threshold", F.col("predicted").alias("selected"),
        F.col("correct").alias("hits"),
        F.try_divide(F.col("correct"), F.col("positives")).alias("hit_share"),
        wasted.alias("wasted"), F.try_divide(wasted, F.col("predicted")).alias("waste_share"),
        (F.col("positives") - F.col("correct")).alias("missed"))


def best_row(df: DataFrame, metric: str, position: str = "pos") -> DataFrame:
    """The row with the highest metric; the first in ``position`` wins ties."""
    return df.orderBy(F.desc_nulls_last(metric), F.asc(position)).limit(1)


def recommended_thresholds(table: DataFrame) -> DataFrame:
    """``(objective, threshold, value)`` for precision, recall and F1.

    ``table`` has one row per threshold, so all three are picked in one pass.
    """
    picks = table.agg(*[
        F.max(F.struct(F.col(m).alias("value"), (-F.col("pos")).alias("order"),
                       F.col("threshold").alias("threshold"))).alias(m)
        for m in ("precision", "recall", "f1")])
    return picks.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("objective"), F.col(m)["threshold"].alias("threshold"),
                 F.col(m)["value"].alias("value")) for m in ("precision", "recall", "f1")])))


def net_benefit(df: DataFrame, label: str, score: str, tie: str,
                invites: Sequence[int] = INVITES, value_per_hit: float = 500_000,
                cost_per_invite: float = 10_000) -> DataFrame:
    """``(invites, tp, fp, net)`` of taking the best ``n`` rows for each ``n``.

    A list longer than the table still charges for every invitation.
    """
    ranked = top_rows(df.select(label, score, tie), score, tie, max(invites))
    hits = ranked.agg(*[F.count_if((F.col("rank") <= n) & (F.col(label) == 1)).alias(f"tp_{n}")
                        for n in invites])
    rows = hits.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("invites"), F.col(f"tp_{n}").alias("tp")) for n in invites])))
    return rows.select(
        "invites", "tp", (F.col("invites") - F.col("tp")).alias("fp"),
        (F.col("tp") * F.lit(float(value_per_hit))
         - F.col("invites") * F.lit(float(cost_per_invite))).alias("net"))
