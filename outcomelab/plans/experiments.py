"""The three ways the operators are used together.

``full_experiment``     derive, split, fit with early stopping, evaluate, decide.
``baseline_comparison`` compare candidates by cross-validated AUC, refit, score.
``score_saved``         score a table with a model saved earlier.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decide, evaluate, model as M
from ..operators.derive import Step, apply_recipe, fit_thresholds
from ..operators.score import score_with, submission
from ..operators.shape import append
from ..operators.split import stratified_folds, stratified_split
from ..sources.models import load_and_score, save_model


@dataclass(frozen=True)
class Experiment:
    model: PipelineModel
    parts: DataFrame             # the prepared table with its split column
    scored: DataFrame            # test part: id, label, score, pred
    metrics: DataFrame
    thresholds: DataFrame
    scenarios: DataFrame
    importance: DataFrame | None


def derive_parts(df: DataFrame, label: str, id_column: str, recipe: Sequence[Step],
                 test_size: float, val_size: float, seed: int) -> DataFrame:
    """Split first, then derive with limits fitted on the training part only."""
    parts = stratified_split(df, label, id_column, test_size, val_size, seed)
    limits = fit_thresholds(parts.where(F.col("split") == "train"), recipe)
    return apply_recipe(parts, recipe, limits)


def full_experiment(df: DataFrame, label: str, id_column: str, candidate: M.Candidate,
                    recipe: Sequence[Step] = (), test_size: float = 0.15,
                    val_size: float = 0.15, seed: int = 42,
                    save_to: str | None = None) -> Experiment:
    """Fit on the training part, stop on the validation part, judge on the test part."""
    parts = derive_parts(df, label, id_column, recipe, test_size, val_size, seed)
    fitting = parts.where(F.col("split") != "test")
    validation = None
    if candidate.kind == "boosted":
        validation = "is_validation"
        fitting = fitting.withColumn(validation, F.col("split") == "val")
    else:
        fitting = fitting.where(F.col("split") == "train")
    model = M.fit(candidate, fitting, label, validation)
    test = parts.where(F.col("split") == "test")
    scored = score_with(model, test, [id_column, label])
    trees = hasattr(model.stages[-1], "featureImportances")
    result = Experiment(
        model, parts, scored,
        evaluate.metrics(scored, label, "pred", "score"),
        decide.threshold_table(scored, label, "score"),
        decide.scenario_table(scored, label, "score"),
        M.feature_importance(model, parts) if trees else None)
    if save_to:
        values = {r["metric"]: r["value"] for r in result.metrics.collect()}
        save_model(model, save_to, df.sparkSession, params=dict(candidate.params),
                   metrics=values, seed=seed, features=M.feature_names(model, parts))
    return result


def baseline_comparison(train: DataFrame, test: DataFrame, label: str, id_column: str,
                        candidates: Sequence[M.Candidate], folds: int = 5, seed: int = 42
                        ) -> tuple[str, DataFrame, DataFrame]:
    """Best candidate's name, fold scores, and the scored test table."""
    folded = stratified_folds(train, label, id_column, folds, seed)
    scores = M.cross_validate(candidates, folded, label, "fold")
    best = M.best_model(scores, [c.name for c in candidates])
    winner = next(c for c in candidates if c.name == best)
    model = M.fit(winner, train, label)
    scored = score_with(model, test, [id_column])
    return best, scores, submission(scored, id_column, id_name=id_column, value_name=label)


def refit_on_all(candidate: M.Candidate, train: DataFrame, val: DataFrame,
                 label: str) -> PipelineModel:
    """Final fit of a chosen candidate on the training and validation rows together."""
    return M.fit(candidate, append(train, val), label)


def score_saved(path: str, df: DataFrame, id_column: str, threshold: float = 0.5,
                value_name: str = "drafted") -> DataFrame:
    scored = load_and_score(path, df, [id_column], threshold)
    return submission(scored, id_column, id_name=id_column, value_name=value_name)
