"""Saved models: the fitted pipeline and one row of JSON beside it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.score import score_with


def save_model(model: PipelineModel, path: str, spark: SparkSession, *,
               params: Mapping[str, object] | None = None,
               metrics: Mapping[str, float] | None = None, seed: int = 42,
               features: Sequence[str] = ()) -> None:
    """Write model and metadata; boosted models also record the trees they kept."""
    model.write().overwrite().save(f"{path}/model")
    last = model.stages[-1]
    meta = {
        "learner": type(last).__name__,
        "best_params": dict(params or {}),
        "metrics": dict(metrics or {}),
        "random_state": seed,
        "feature_names": list(features),
        "best_iteration": last.getNumTrees if hasattr(last, "getNumTrees") else None,
    }
    row = spark.createDataFrame([(json.dumps(meta),)], "value string")
    row.write.mode("overwrite").text(f"{path}/metadata")


def load_model(path: str, spark: SparkSession) -> tuple[PipelineModel, dict]:
    meta = spark.read.text(f"{path}/metadata").first()["value"]
    return PipelineModel.load(f"{path}/model"), json.loads(meta)


def load_and_score(path: str, df: DataFrame, keep: Sequence[str],
                   threshold: float = 0.5) -> DataFrame:
    """Score a table with a saved model."""
    model, _ = load_model(path, df.sparkSession)
    return score_with(model, df, keep, threshold)
