"""Evaluation tables for a 0/1 label against decisions or scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import number, right_closed_bin
from .dist import histogram
from .ordering import running_totals

METRICS = ("accuracy", "precision", "recall", "f1")


def _div(a, b) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def f1_of(precision: Column, recall: Column) -> Column:
    return _div(2 * precision * recall, precision + recall)


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row ``tn, fp, fn, tp`` in one pass."""
    y, p = F.col(label), F.col(pred)
    return df.agg(*[F.count_if((y == a) & (p == b)).alias(n)
                    for n, a, b in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """``(label, pred, n, share_total, share_row)`` with all four cells."""
    counts = confusion_counts(df, label, pred)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    row = {0: F.col("tn") + F.col("fp"), 1: F.col("fn") + F.col("tp")}
    cells = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("pred"), F.col(n).alias("n"),
                      _div(F.col(n), total).alias("share_total"),
                      _div(F.col(n), row[a]).alias("share_row"))
             for n, a, b in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))]
    return counts.select(F.inline(F.array(*cells)))


def _metric_columns() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = _div(tp, tp + fp), _div(tp, tp + fn)
    return {"accuracy": _div(tp + tn, tp + tn + fp + fn), "precision": precision,
            "recall": recall, "f1": f1_of(precision, recall)}


def metrics(df: DataFrame, label: str, pred: str, score: str | None = None) -> DataFrame:
    """``(metric, value)``: accuracy, precision, recall, F1 and, with a score, the AUC."""
    wide = confusion_counts(df, label, pred).select(
        *[c.alias(m) for m, c in _metric_columns().items()])
    out = wide.unpivot([], list(METRICS), "metric", "value")
    if score:
        area = roc_auc(df, label, score).select(F.lit("roc_auc").alias("metric"),
                                                F.col("auc").alias("value"))
        out = out.unionByName(area)
    return out


def classification_report(df: DataFrame, label: str, pred: str,
                          names: tuple[str, str] = ("0", "1")) -> DataFrame:
    """``(name, precision, recall, f1, support)`` per class, then the three averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per_class = []
    for hit, called, real in ((tn, tn + fn, tn + fp), (tp, tp + fp, tp + fn)):
        precision, recall = _div(hit, called), _div(hit, real)
        per_class.append((precision, recall, f1_of(precision, recall), real))
    total = tn + fp + fn + tp
    accuracy = _div(tn + tp, total)

    def row(name: str, values, support: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), *[
            v.alias(n) for v, n in zip(values, ("precision", "recall", "f1"))],
            support.alias("support"))

    zero, one = per_class
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [_div(a * zero[3] + b * one[3], total) for a, b in zip(zero[:3], one[:3])]
    rows = [row(names[0], zero[:3], zero[3]), row(names[1], one[:3], one[3]),
            row("accuracy", [accuracy] * 3, total), row("macro avg", macro, total),
            row("weighted avg", weighted, total)]
    return confusion_counts(df, label, pred).select(F.inline(F.array(*rows)))


def _score_totals(df: DataFrame, label: str, score: str, descending: bool,
                  following: bool = False) -> DataFrame:
    y = F.col(label)
    return running_totals(df.where(y.isin(0, 1)), score, {
        "pos": (y == 1).cast("bigint"), "neg": (y == 0).cast("bigint")}, descending, following=following)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``auc``: exact, ties counted half."""
    t = _score_totals(df, label, score, descending=False)
    pairs = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return t.agg(F.try_divide(
        pairs, F.max("pos_total").cast("double") * F.max("neg_total")).alias("auc"))


def roc_points(df: DataFrame, label: str, score: str, thinned: bool = False) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score, counting scores at or above it.

    The starting point (0, 0) has an infinite threshold.  With ``thinned``, points whose
    next step repeats their own are left out (the first and the last stay): they lie on
    the line between their neighbours, so the area is the same.
    """
    t = _score_totals(df, label, score, descending=True, following=thinned)
    if thinned:
        ends = F.col("pos_next").isNull() | ((F.col("pos_before") == 0) & (F.col("neg_before") == 0))
        t = t.where(ends | (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg")))
    points = t.select(
        F.col(score).alias("threshold"),
        F.try_divide(F.col("neg_before") + F.col("neg"), F.col("neg_total")).alias("fpr"),
        F.try_divide(F.col("pos_before") + F.col("pos"), F.col("pos_total")).alias("tpr"))
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """``(bin, n, mean_score, positive_share)`` over equal probability steps.

    A score on an inner edge belongs to the lower bin; empty bins are left out.
    """
    s = number(score)
    inner = [i * (1.0 / bins) for i in range(1, bins)]
    bin_ = right_closed_bin(s, [-1.0, *inner, 2.0])
    return (df.select(bin_.alias("bin"), s.alias("s"), F.col(label).alias("y"))
            .where(F.col("bin").isNotNull()).groupBy("bin")
            .agg(F.count("y").alias("n"), F.avg("s").alias("mean_score"),
                 F.avg("y").alias("positive_share")))


def score_histogram(df: DataFrame, label: str, score: str, bins: int = 50) -> DataFrame:
    return histogram(df, score, label, bins)


def compare_models(results: Mapping[str, DataFrame]) -> DataFrame:
    """``(metric, <model>...)`` from ``metrics`` tables; an absent metric counts as 0."""
    stacked = None
    for name, table in results.items():
        part = table.where(F.col("metric").isin(list(METRICS))).select(
            F.lit(name).alias("model"), "metric", "value")
        stacked = part if stacked is None else stacked.unionByName(part)
    spark = stacked.sparkSession
    wanted = spark.createDataFrame([(m,) for m in METRICS], "metric string")
    wide = stacked.groupBy("metric").pivot("model", list(results)).agg(F.first("value"))
    return wanted.join(wide, "metric", "left").na.fill(0.0, list(results))
