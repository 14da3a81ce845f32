"""Preparation for models: fit on one table, apply to any other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import filled_category, is_numeric, number, numbers, numeric_columns
from .ordering import quantiles, quantiles_outside

INFREQUENT = "__infrequent__"


# --- missing values ---------------------------------------------------------

def fit_fill(df: DataFrame, strategy: str = "median",
             columns: Sequence[str] | None = None) -> dict[str, float]:
    """Fill value per numeric column; columns without any value are skipped."""
    columns = list(columns or numeric_columns(df))
    if strategy == "median":
        found = quantiles(df, columns, [0.5])
        values = {c: found[(None, c)][0] for c in columns}
    elif strategy == "mean":
        row = numbers(df, columns).agg(*[F.avg(c).alias(c) for c in columns]).first()
        values = {c: row[c] for c in columns}
    else:
        raise ValueError(f"unknown strategy {strategy!r}: use 'median', 'mean' or 'drop'")
    return {c: float(v) for c, v in values.items() if v is not None}


def fit_fill_outside(df: DataFrame, fold: str, columns: Sequence[str]) -> dict[object, dict[str, float]]:
    """For each fold the medians of the rows of the other folds, as ``fit_fill`` finds them."""
    columns = list(columns)
    out: dict[object, dict[str, float]] = {}
    for (k, c), (v,) in quantiles_outside(df, columns, [0.5], fold).items():
        out.setdefault(k, {})
        if v is not None:
            out[k][c] = float(v)
    return out


def apply_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL (and NaN) by fitted values; numeric columns become double."""
    exprs = {}
    for c, v in values.items():
        if c not in df.columns:
            continue
        if is_numeric(df.schema[c].dataType):
            exprs[c] = F.coalesce(number(c), F.lit(float(v)))
        else:
            exprs[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(exprs)


def handle_missing(df: DataFrame, strategy: str = "median",
                   fit_on: DataFrame | None = None,
                   columns: Sequence[str] | None = None) -> DataFrame:
    if strategy == "drop":
        return df.na.drop("any", subset=list(columns) if columns else None)
    fitted = fit_fill(df if fit_on is None else fit_on, strategy, columns)
    return apply_fill(df, fitted)


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, text_value, number_value)``: the most frequent value per column.

    Ties go to the smallest value.  Values are counted in long form with a
    map-side combine, so neither a frequent value nor a near-unique column ends
    up in one aggregation buffer.
    """
    numeric = [c for c in columns if is_numeric(df.schema[c].dataType)]
    text = [c for c in columns if c not in numeric]
    out = None
    for names, kind in ((numeric, "number"), (text, "text")):
        if not names:
            continue
        long = df.select(*[(number(c) if kind == "number" else F.col(c).cast("string")).alias(c)
                           for c in names]).unpivot([], names, "column", "value")
        best = (long.where(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best"))
                .select("column", F.col("best.value").alias("value")))
        empty_text, empty_number = F.lit(None).cast("string"), F.lit(None).cast("double")
        best = best.select(
            "column",
            (F.col("value") if kind == "text" else empty_text).alias("text_value"),
            (F.col("value") if kind == "number" else empty_number).alias("number_value"))
        out = best if out is None else out.unionByName(best)
    return out


def fit_modes(df: DataFrame, target: str | None = None,
              columns: Sequence[str] | None = None) -> dict[str, object]:
    columns = [c for c in (columns or df.columns) if c != target]
    return {r["column"]: r["text_value"] if r["text_value"] is not None else r["number_value"]
            for r in modes(df, columns).collect()}


# --- scaling ----------------------------------------------------------------

@dataclass(frozen=True)
class Scaler:
    """Fitted mean and population deviation per column."""

    mean: Mapping[str, float]
    scale: Mapping[str, float]
    centred: bool = True

    def apply(self, df: DataFrame) -> DataFrame:
        def scaled(c: str):
            centre = self.mean[c] if self.centred else 0.0
            return (number(c) - F.lit(centre)) / F.lit(self.scale[c])
        return df.withColumns({c: scaled(c) for c in self.scale if c in df.columns})


def fit_scaler(df: DataFrame, columns: Sequence[str], with_mean: bool = True) -> Scaler:
    """One aggregation for all columns; a constant column is divided by one."""
    row = numbers(df, columns).agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return Scaler({c: row[f"m_{c}"] or 0.0 for c in columns},
                  {c: row[f"s_{c}"] or 1.0 for c in columns}, with_mean)


# --- categories -------------------------------------------------------------

def fit_codes(df: DataFrame, columns: Sequence[str]) -> StringIndexerModel:
    """Alphabetical codes over the filled categories of the fitting table."""
    filled = df.select(*[filled_category(c).alias(c) for c in columns])
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_encoded" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep").fit(filled)


def apply_codes(df: DataFrame, model: StringIndexerModel, keep: bool = False) -> DataFrame:
    """Append ``<column>_encoded`` and drop the source.

    A level the model has not seen gets -1.
    """
    columns = model.getInputCols()
    filled = df.withColumns({c: filled_category(c) for c in columns})
    coded = model.transform(filled)
    sizes = {c: len(labels) for c, labels in zip(columns, model.labelsArray)}
    coded = coded.withColumns({
        f"{c}_encoded": F.when(F.col(f"{c}_encoded") < sizes[c], F.col(f"{c}_encoded"))
        .otherwise(F.lit(-1.0)).cast("int") for c in columns})
    return coded if keep else coded.drop(*columns)


def one_hot_stages(columns: Sequence[str]) -> list:
    """Indexer and encoder: one slot per seen level, all zeros for an unseen one."""
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed,
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_onehot" for c in columns],
                      dropLast=True, handleInvalid="error"),
    ]


def level_table(df: DataFrame, column: str, min_frequency: int | float) -> DataFrame:
    """``(column, slot)``: each seen level, rare ones sent to a shared slot.

    A whole number is a row count, a fraction a share of the non-missing rows.
    """
    counted = (df.where(F.col(column).isNotNull()).groupBy(column)
               .agg(F.count(F.lit(1)).alias("n")))
    if isinstance(min_frequency, float):
        limit = df.agg((F.count(column) * F.lit(min_frequency)).alias("limit")).scalar()
    else:
        limit = F.lit(min_frequency)
    return counted.select(column, F.when(F.col("n") >= limit, F.col(column))
                          .otherwise(F.lit(INFREQUENT)).alias("slot"))


def group_rare_levels(df: DataFrame, levels: DataFrame, column: str) -> DataFrame:
    """Replace rare levels by the shared slot; unseen levels become NULL.

    A plain equi-join: the optimizer broadcasts the level table when its
    measured size allows, and splits a skewed level otherwise.
    """
    out = df.join(levels, column, "left")
    return out.select(*[F.col("slot").alias(column) if c == column else F.col(c)
                        for c in df.columns])


def domain_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    sizes = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns])
    return sizes.unpivot([], list(columns), "column", "categories")


# --- assembly and weights ---------------------------------------------------

def assembler(numeric: Sequence[str], categorical: Sequence[str] = (),
              out: str = "features") -> VectorAssembler:
    """Numeric columns first, then indexed categories, in a fixed order."""
    return VectorAssembler(inputCols=[*numeric, *categorical], outputCol=out,
                           handleInvalid="keep")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, balanced, positive)``: n/(k·n_c), and negatives/positives for class 1."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    y = F.col(label)
    sizes = df.agg(F.struct(
        F.count(y).alias("n"), F.count_distinct(y).alias("k"),
        F.count_if(y == 0).alias("neg"), F.count_if(y == 1).alias("pos")).alias("s")).scalar()
    return counts.select(
        label, "n",
        (sizes.getField("n") / (sizes.getField("k") * F.col("n"))).alias("balanced"),
        F.when(y == 1, F.coalesce(F.try_divide(sizes.getField("neg"), sizes.getField("pos")),
                                  F.lit(1.0))).otherwise(F.lit(1.0)).alias("positive"))


def add_class_weight(df: DataFrame, label: str, kind: str = "balanced",
                     out: str = "weight", fit_on: DataFrame | None = None) -> DataFrame:
    """Append the class weight as a literal per class (classes are few)."""
    weights = class_weights(df if fit_on is None else fit_on, label).collect()
    expr = F.lit(None).cast("double")
    for row in weights:
        expr = F.when(F.col(label) == row[label], F.lit(row[kind])).otherwise(expr)
    return df.withColumn(out, expr)
