"""A forest whose bootstrap draws can be replayed, so that rows can be scored out of bag.

How often a tree sees a row is a Poisson draw of mean 1 from a hash of the row's id and
the tree's number: the same on every run, in every task, and without moving a row.  Trees
are Spark's own, fitted with the draws as weights; a row's out-of-bag score is the mean
over the trees that did not see it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .evaluate import metrics, roc_auc
from .model import FEATURES, WEIGHT, fit_preparation, use_checkpoints
from .prep import add_class_weight
from .split import row_hash

#: Chances of at most 0, 1, ... draws of a Poisson count of mean 1; beyond the last it counts one more.
POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(8)]


def bootstrap_draw(id_column: str, tree: int, seed: int = 42) -> Column:
    """How often the tree's sample holds the row; rows with one id are drawn alike."""
    digits = F.substring(F.md5(F.concat(row_hash(id_column, seed), F.lit(f"|{tree}"))), 1, 12)
    u = F.conv(digits, 16, 10).cast("double") / float(1 << 48)
    draw = F.lit(len(POISSON))
    for k in range(len(POISSON) - 1, -1, -1):
        draw = F.when(u < POISSON[k], F.lit(k)).otherwise(draw)
    return draw


@dataclass
class BaggedForest:
    """Preparation and trees; ``oob`` holds the out-of-bag metrics of the training rows."""

    preparation: PipelineModel
    trees: list[RandomForestClassificationModel]
    seed: int
    oob: dict[str, float | None] = field(default_factory=dict)

    def _votes(self, ready: DataFrame, seen: Sequence[Column | None]) -> DataFrame:
        """Appends the sum and number of the votes of trees that count for the row."""
        total, n = F.lit(0.0), F.lit(0)
        for k, (tree, counts) in enumerate(zip(self.trees, seen)):
            vote = f"__vote{k}"
            one = tree.copy({tree.probabilityCol: vote, tree.rawPredictionCol: "", tree.predictionCol: ""})
            ready = one.transform(ready)
            p = vector_to_array(vote)[1]
            total = total + (p if counts is None else F.when(counts, p).otherwise(0.0))
            n = n + (F.lit(1) if counts is None else counts.cast("int"))
        return ready.withColumns({"__total": total, "__n": n}).drop(*[f"__vote{k}" for k in range(len(self.trees))])

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` with the mean vote of all trees."""
        voted = self._votes(self.preparation.transform(df), [None] * len(self.trees))
        return voted.select(*[F.col(f"`{c}`") for c in df.columns], F.try_divide("__total", "__n").alias(out))

    def out_of_bag(self, df: DataFrame, id_column: str, out: str = "oob_score") -> DataFrame:
        """``df`` with the mean vote of the trees that did not see the row; null if all did."""
        missed = [bootstrap_draw(id_column, k, self.seed) == 0 for k in range(len(self.trees))]
        voted = self._votes(self.preparation.transform(df), missed)
        return voted.select(*[F.col(f"`{c}`") for c in df.columns], F.try_divide("__total", "__n").alias(out))


def fit_bagged_forest(df: DataFrame, label: str, id_column: str, numeric: Sequence[str],
                      categorical: Sequence[str] = (), trees: int = 100, depth: int = 10, min_rows: int = 1,
                      share: str = "sqrt", weighted: bool = True, seed: int = 42) -> BaggedForest:
    """Fit the forest and its out-of-bag metrics (accuracy, precision, recall, f1, roc_auc, rows).

    Rows without a 0/1 label are left out.  ``share`` is Spark's feature subset strategy.
    """
    use_checkpoints(df)
    columns = list(dict.fromkeys([label, id_column, *numeric, *categorical]))
    rows = df.where(F.col(label).isin(0, 1)).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    prep = fit_preparation(rows, numeric, categorical, scale=False)
    ready = prep.transform(rows)
    ready = add_class_weight(ready, label, out=WEIGHT) if weighted else ready.withColumn(WEIGHT, F.lit(1.0))
    ready = ready.select(label, id_column, FEATURES, WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
    forest = BaggedForest(prep, [], seed)
    try:
        for k in range(trees):
            draw = bootstrap_draw(id_column, k, seed)
            sample = ready.withColumn("__w", F.col(WEIGHT) * draw).where(draw > 0)
            forest.trees.append(RandomForestClassifier(
                labelCol=label, featuresCol=FEATURES, weightCol="__w", numTrees=1, maxDepth=depth,
                minInstancesPerNode=min_rows, bootstrap=False, featureSubsetStrategy=share,
                seed=seed + k).fit(sample))
        scored = forest.out_of_bag(rows, id_column).where("oob_score IS NOT NULL").select(
            F.col(label).alias("y"), F.col("oob_score").alias("s"), (F.col("oob_score") > 0.5).cast("int").alias("pred"))
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        forest.oob = {r["metric"]: r["value"] for r in metrics(scored, "y", "pred").collect()}
        forest.oob["roc_auc"] = roc_auc(scored, "y", "s").first()["auc"]
        forest.oob["rows"] = float(scored.count())
        scored.unpersist()
    finally:
        ready.unpersist()
        rows.unpersist()
    return forest
