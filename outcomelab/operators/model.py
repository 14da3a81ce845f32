"""Training, comparison and search with Spark ML."""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import HELD, cut_lineage, shared_folder
from .evaluate import metrics
from .prep import (
    INFREQUENT, add_class_weight, fit_fill, fit_fill_outside, fit_modes, fit_scaler, level_table,
)
from .score import score_with

FEATURES, WEIGHT = "features", "class_weight"
MAX_LEVELS = 10_000
#: Of the blocks that logistic regression keeps its rows in; half a megabyte and more is a
#: region or several of its own in small heaps, and a task that reads blocks back holds up to 100.
BLOCK_MB = 0.25

# Starting parameters and search ranges, kept to what Spark ML offers.
BASE_PARAMS: dict[str, dict[str, object]] = {
    "boosted": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1},
    "forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2,
               "featureSubsetStrategy": "sqrt", "impurity": "gini"},
    "logistic": {"maxIter": 5000, "tol": 1e-4, "C": 1.0},
}
CANDIDATES: dict[str, tuple[str, dict[str, object]]] = {
    "logistic_regression": ("logistic", {}),
    "random_forest": ("forest", {"numTrees": 400, "maxDepth": 30, "minInstancesPerNode": 1}),
    "boosted_trees": ("boosted", {"maxIter": 600, "maxDepth": 6, "stepSize": 0.05,
                                  "subsamplingRate": 0.9}),
}
SPACES: dict[str, dict[str, tuple]] = {
    "boosted": {"maxDepth": ("int", 3, 12), "stepSize": ("log", 0.01, 0.3)},
    "boosted_shallow": {"maxDepth": ("int", 4, 10), "stepSize": ("log", 0.01, 0.3)},
    "forest": {"numTrees": ("int", 50, 500), "maxDepth": ("int", 3, 20),
               "minInstancesPerNode": ("int", 1, 10), "subsamplingRate": ("float", 0.5, 1.0),
               "featureSubsetStrategy": ("choice", "sqrt", "log2", "all")},
    "forest_grid": {"numTrees": ("choice", 100, 200, 500, 1000),
                    "maxDepth": ("choice", 30, 10, 20),
                    "minInstancesPerNode": ("choice", 1, 2, 4),
                    "featureSubsetStrategy": ("choice", "sqrt", "0.3", "0.5")},
}


# --- preparation as pipeline stages ------------------------------------------

def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _named(column: str) -> str:
    return f"`{column}`"


def _with_rare_levels(train: DataFrame, column: str, source: str,
                      min_frequency: int) -> tuple[str, str]:
    """SQL that keeps frequent levels, merges rare ones and leaves unseen ones NULL.

    The second part is a join the SQL needs, or empty: the rare levels are listed in the
    SQL up to ``MAX_LEVELS`` of them, and written to a table of the shared folder beyond
    that, with the same result.  Frequent levels are vector slots, so the vector's width
    bounds them; it is checked before they are brought to the driver.
    """
    levels = level_table(train, column, min_frequency).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        is_rare = F.col("slot") == INFREQUENT
        frequent, rare = ([r[column] for r in levels.where(which).limit(MAX_LEVELS + 1).collect()]
                          for which in (~is_rare, is_rare))
        if len(frequent) > MAX_LEVELS:
            raise ValueError(f"{column} has more than {MAX_LEVELS} frequent levels, a vector slot each: "
                             "raise min_frequency, or encode the column by its target statistic")
        sql, join = "CASE WHEN false THEN ''", ""
        if frequent:
            sql += f" WHEN {source} IN ({', '.join(sorted(map(_quoted, frequent)))}) THEN {source}"
        if len(rare) > MAX_LEVELS:
            path = f"{shared_folder(train.sparkSession)}/levels-{uuid.uuid4().hex}"
            known = f"`__rare_{column}`"
            levels.where(is_rare).select(F.col(column).cast("string").alias("level")).write.parquet(path)
            join = f" LEFT JOIN (SELECT level AS {known} FROM parquet.`{path}`) ON {source} = {known}"
            sql += f" WHEN {known} IS NOT NULL THEN {_quoted(INFREQUENT)}"
        elif rare:
            sql += f" WHEN {source} IN ({', '.join(sorted(map(_quoted, rare)))}) THEN {_quoted(INFREQUENT)}"
        return f"{sql} END", join
    finally:
        levels.unpersist()


def fit_preparation(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                    scale: bool = True, encode: str = "onehot",
                    min_frequency: int | None = 20,
                    medians: Mapping[str, float] | None = None) -> PipelineModel:
    """Fitted preparation that can be saved with the model.

    Numbers: exact train median (``medians`` if found before), then division by the train deviation.
    Categories: train mode, rare levels in one slot, then one-hot or index.
    Fitted values become literals of a SQL stage, so scoring needs no join.
    """
    if medians is None:
        medians = fit_fill(train, "median", numeric) if numeric else {}
    else:
        medians = {c: medians[c] for c in numeric if c in medians}
    filled = train.na.fill({c: v for c, v in medians.items()}) if medians else train
    scaler = fit_scaler(filled, list(medians)) if scale and medians else None
    parts = []
    for c, v in medians.items():
        value = f"coalesce(nanvl(CAST({_named(c)} AS DOUBLE), NULL), {v!r}D)"
        parts.append(f"{value} / {(scaler.scale[c] if scaler else 1.0)!r}D AS {_named(c + '_in')}")
    top, joins = fit_modes(train, columns=categorical) if categorical else {}, ""
    for c in categorical:
        mode = str(top.get(c, ""))
        source = f"coalesce(CAST({_named(c)} AS STRING), {_quoted(mode)})"
        if min_frequency:
            source, join = _with_rare_levels(train.na.fill({c: mode}), c, source, min_frequency)
            joins += join
        parts.append(f"{source} AS {_named(c + '_level')}")
    inputs = [f"{c}_in" for c in medians]
    stages: list = [SQLTransformer(statement=f"SELECT __THIS__.*, {', '.join(parts)} FROM __THIS__{joins}")]
    if categorical:
        stages.append(StringIndexer(
            inputCols=[f"{c}_level" for c in categorical],
            outputCols=[f"{c}_index" for c in categorical],
            stringOrderType="alphabetAsc", handleInvalid="keep"))
        if encode == "onehot":
            stages.append(OneHotEncoder(
                inputCols=[f"{c}_index" for c in categorical],
                outputCols=[f"{c}_slots" for c in categorical], dropLast=True))
            inputs += [f"{c}_slots" for c in categorical]
        else:
            inputs += [f"{c}_index" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the vector slots in order, from the assembler's metadata."""
    meta = model.transform(df.limit(0)).schema[FEATURES].metadata["ml_attr"]
    slots = {a["idx"]: a["name"] for group in meta["attrs"].values() for a in group}
    return [slots[i] for i in range(meta["num_attrs"])]


# --- learners -----------------------------------------------------------------

def learner(kind: str, label: str, rows: float, seed: int = 42, validation: str | None = None,
            weighted: bool = True, max_bins: int = 32, **params):
    """A Spark ML classifier with the shared column names.

    ``validation`` names a boolean column; boosting then stops once the loss on
    those rows no longer improves.  ``C`` becomes ``1 / (C * rows)``, because
    balanced weights sum to the number of rows.
    """
    if kind not in BASE_PARAMS:
        raise ValueError(f"unknown learner {kind!r}: use one of {sorted(BASE_PARAMS)}")
    settings = {**BASE_PARAMS[kind], **params}
    common = {"labelCol": label, "featuresCol": FEATURES}
    if weighted:
        common["weightCol"] = WEIGHT
    if kind == "boosted":
        extra = {"validationIndicatorCol": validation} if validation else {}
        return GBTClassifier(seed=seed, maxBins=max_bins, cacheNodeIds=True, **common,
                             **extra, **settings)
    if kind == "forest":
        return RandomForestClassifier(seed=seed, maxBins=max_bins, cacheNodeIds=True,
                                      **common, **settings)
    strength = float(settings.pop("C"))
    settings.setdefault("maxBlockSizeInMB", BLOCK_MB)
    return LogisticRegression(regParam=1.0 / (strength * max(rows, 1.0)), elasticNetParam=0.0,
                              standardization=False, **common, **settings)


@dataclass(frozen=True)
class Candidate:
    """What to train: preparation choices plus a learner and its parameters."""

    name: str
    kind: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    params: Mapping[str, object] = field(default_factory=dict)
    weighted: bool = True
    encode: str = "onehot"
    min_frequency: int | None = 20
    seed: int = 42


@contextmanager
def held(df: DataFrame, columns: Sequence[str]):
    """The wanted columns, computed once for many fits.

    With a checkpoint folder they are written there, so a lost executor costs a
    re-read; otherwise they stay on the executors' disks and are recomputed if lost.
    """
    use_checkpoints(df)
    narrow = df.select(*dict.fromkeys(columns))
    if df.sparkSession.sparkContext.getCheckpointDir():
        yield cut_lineage(narrow)
        return
    narrow = narrow.persist(HELD)
    try:
        yield narrow
    finally:
        narrow.unpersist()


def use_checkpoints(df: DataFrame) -> None:
    """Let iterative training cut its lineage in the folder the cluster names."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


@dataclass(frozen=True)
class Prepared:
    """A table after its preparation, held for as many fits as are wanted."""

    preparation: PipelineModel
    ready: DataFrame            # label, features, weight and validation flag where wanted
    rows: float
    bins: int
    label: str
    validation: str | None


def preparation_of(candidate: Candidate) -> tuple:
    """What a candidate's preparation depends on; its learner's parameters are no part of it."""
    return (tuple(candidate.numeric), tuple(candidate.categorical), candidate.kind == "logistic",
            candidate.encode, candidate.min_frequency, candidate.weighted)


@contextmanager
def prepared(candidate: Candidate, train: DataFrame, label: str, validation: str | None = None,
             hold_input: bool = True, medians: Mapping[str, float] | None = None):
    """Fit the candidate's preparation and hold the table it gives, for ``fit_learner``.

    Rows flagged by ``validation`` steer early stopping only: the preparation
    and the class weights come from the others.  Preparation reads the table
    several times, so the columns it needs are held on the executors meanwhile;
    ``hold_input=False`` skips that for a table the caller already holds.
    """
    use_checkpoints(train)
    train = train.select(label, *candidate.numeric, *candidate.categorical,
                         *([validation] if validation else []))
    if hold_input:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    fitting = train.where(~F.col(validation)) if validation else train
    prep = fit_preparation(fitting, candidate.numeric, candidate.categorical,
                           candidate.kind == "logistic", candidate.encode,
                           candidate.min_frequency, medians)
    ready = prep.transform(train)
    if candidate.weighted:
        ready = add_class_weight(ready, label, out=WEIGHT, fit_on=fitting.select(label))
    ready = ready.select(label, FEATURES, *([WEIGHT] if candidate.weighted else []),
                         *([validation] if validation else []))
    ready = ready.persist(HELD)
    try:
        rows = float(ready.count())
        if hold_input:
            train.unpersist()
        bins = 32
        if candidate.encode == "index":
            sizes = [len(labels) + 1 for stage in prep.stages if hasattr(stage, "labelsArray")
                     for labels in stage.labelsArray]
            bins = max([bins, *sizes])
        yield Prepared(prep, ready, rows, bins, label, validation)
    finally:
        ready.unpersist()


def fit_learner(candidate: Candidate, table: Prepared) -> PipelineModel:
    """The candidate's learner alone, fitted on a table prepared for it; scores such tables."""
    return PipelineModel(stages=[learner(
        candidate.kind, table.label, table.rows, candidate.seed, table.validation,
        candidate.weighted, table.bins, **candidate.params).fit(table.ready)])


def fit(candidate: Candidate, train: DataFrame, label: str, validation: str | None = None,
        hold_input: bool = True) -> PipelineModel:
    """Fit preparation and learner on the table; both end up in one saved model.

    ``validation`` and ``hold_input`` as in ``prepared``.
    """
    with prepared(candidate, train, label, validation, hold_input) as table:
        return PipelineModel(stages=[*table.preparation.stages, *fit_learner(candidate, table).stages])


@contextmanager
def prepared_pair(candidate: Candidate, train: DataFrame, test: DataFrame, label: str,
                  medians: Mapping[str, float] | None = None):
    """``(prepared train, prepared test)`` of tables that the caller holds; both are kept until the end."""
    with prepared(candidate, train, label, hold_input=False, medians=medians) as table:
        judged = table.preparation.transform(test).select(label, FEATURES)
        judged = judged.persist(HELD)
        try:
            yield table, judged
        finally:
            judged.unpersist()


def auc_of(model: PipelineModel, df: DataFrame, label: str) -> float:
    """Area under the ROC curve, exact (no down-sampled curve)."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="probability", metricName="areaUnderROC", numBins=0)
    return float(evaluator.evaluate(model.transform(df)))


def f1_at(model: PipelineModel, df: DataFrame, label: str, threshold: float = 0.5) -> float:
    scored = score_with(model, df, [label], threshold)
    return float(metrics(scored, label, "pred").where(F.col("metric") == "f1").first()["value"])


def evaluate_fit(model: PipelineModel, df: DataFrame, label: str) -> dict[str, float]:
    # Counts and the area read the scores several times; scoring is the costly part.
    scored = score_with(model, df, [label]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {r["metric"]: r["value"] for r in metrics(scored, label, "pred", "score").collect()}
    finally:
        scored.unpersist()


# --- cross-validation and search ------------------------------------------------

def cross_validate(candidates: Sequence[Candidate], df: DataFrame, label: str, fold: str,
                   parallelism: int = 2) -> DataFrame:
    """``(model, fold, auc)``: each fold is scored by a model fitted on the others.

    Candidates with one preparation share it: it is fitted once a fold.  The medians of all
    folds are found together.
    """
    wanted = [label, fold, *[c for x in candidates for c in (*x.numeric, *x.categorical)]]
    shared: dict[tuple, list[int]] = {}
    for i, candidate in enumerate(candidates):
        shared.setdefault(preparation_of(candidate), []).append(i)
    with held(df, wanted) as table:
        folds = sorted(r[fold] for r in table.select(fold).distinct().collect())
        numeric = list(dict.fromkeys(c for x in candidates for c in x.numeric))
        medians = fit_fill_outside(table, fold, numeric) if numeric else {}

        def run(task: tuple[int, list[int]]) -> list[tuple[int, int, float]]:
            k, group = task
            with prepared_pair(candidates[group[0]], table.where(F.col(fold) != k),
                               table.where(F.col(fold) == k), label, medians.get(k)) as (train, test):
                return [(i, k, auc_of(fit_learner(candidates[i], train), test, label)) for i in group]

        with ThreadPool(parallelism) as pool:
            found = pool.map(run, [(k, group) for group in shared.values() for k in folds])
    rows = [(candidates[i].name, k, auc) for i, k, auc in sorted(x for part in found for x in part)]
    return df.sparkSession.createDataFrame(rows, "model string, fold int, auc double")


def cv_summary(scores: DataFrame) -> DataFrame:
    """``(model, mean_auc, std_auc, fold_scores)`` with the population deviation."""
    return scores.groupBy("model").agg(
        F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"),
        F.transform(F.sort_array(F.collect_list(F.struct("fold", "auc"))),
                    lambda s: s["auc"]).alias("fold_scores"))


def best_model(scores: DataFrame, order: Sequence[str]) -> str:
    """Highest mean AUC; the earlier candidate wins ties."""
    means = {r["model"]: r["mean_auc"] for r in cv_summary(scores).collect()}
    return max(order, key=lambda name: (means[name], -order.index(name)))


def draw(space: Mapping[str, tuple], n: int, seed: int = 42) -> list[dict[str, object]]:
    """``n`` seeded random parameter settings from a named space."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        setting: dict[str, object] = {}
        for name, (kind, *limits) in space.items():
            if kind == "int":
                setting[name] = rng.randint(*limits)
            elif kind == "float":
                setting[name] = rng.uniform(*limits)
            elif kind == "log":
                setting[name] = math.exp(rng.uniform(*map(math.log, limits)))
            else:
                setting[name] = rng.choice(limits)
        out.append(setting)
    return out


def search(base: Candidate, space: Mapping[str, tuple], train: DataFrame, label: str,
           n_trials: int, validate: DataFrame | None = None, fold: str | None = None,
           objective: str = "auc", seed: int = 42, parallelism: int = 2
           ) -> tuple[Candidate, DataFrame]:
    """Random search; returns the best candidate and the trial log ``(trial, params, value)``.

    Trials are judged on ``validate``, or by cross-validation over ``fold``.  They differ in
    the learner's parameters alone, so the preparation is fitted once (once a fold).
    """
    if (validate is None) == (fold is None):
        raise ValueError("give either a validation table or a fold column")
    settings = draw(space, n_trials, seed)
    judge: Callable[[PipelineModel, DataFrame, str], float] = \
        auc_of if objective == "auc" else f1_at
    wanted = [label, *base.numeric, *base.categorical, *([fold] if fold else [])]
    with held(train, wanted) as table:
        medians = fit_fill_outside(table, fold, base.numeric) if fold and base.numeric else {}
        pairs = [(table, validate, None)] if fold is None else [
            (table.where(F.col(fold) != k), table.where(F.col(fold) == k), medians.get(k))
            for k in sorted(r[fold] for r in table.select(fold).distinct().collect())]
        trials = [Candidate(**{**base.__dict__, "params": {**base.params, **s}}) for s in settings]
        totals = [0.0] * n_trials
        for train_part, test_part, found_before in pairs:
            with prepared_pair(base, train_part, test_part, label, found_before) as (ready, judged), ThreadPool(parallelism) as pool:
                found = pool.map(lambda trial: judge(fit_learner(trial, ready), judged, label), trials)
            totals = [a + b for a, b in zip(totals, found)]
    values = [total / len(pairs) for total in totals]
    best = max(range(n_trials), key=lambda i: (values[i], -i))
    log = train.sparkSession.createDataFrame(
        [(i, {k: str(v) for k, v in s.items()}, values[i]) for i, s in enumerate(settings)],
        "trial int, params map<string,string>, value double")
    winner = Candidate(**{**base.__dict__, "params": {**base.params, **settings[best]}})
    return winner, log


# --- importance -----------------------------------------------------------------

def importance_shares(importances: DataFrame, top: int = 20) -> DataFrame:
    """``(feature, importance, share_pct, cum_pct)``, shares among the kept rows."""
    best = importances.orderBy(F.desc("importance"), "feature").limit(top)
    # At most ``top`` rows from here on.
    everything = Window.orderBy(F.desc("importance"), "feature").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.orderBy(F.desc("importance"), "feature").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    share = F.coalesce(F.try_divide(
        F.col("importance"), F.sum("importance").over(everything)), F.lit(0.0)) * 100
    return (best.withColumn("share_pct", share)
            .withColumn("cum_pct", F.sum("share_pct").over(so_far)))


def features_to_reach(shares: DataFrame, percent: float = 80.0) -> DataFrame:
    """How many of the ranked features stay under the wanted cumulative share, plus one."""
    return shares.agg((F.count_if(F.col("cum_pct") < percent) + 1).alias("n_features"))


def feature_importance(model: PipelineModel, df: DataFrame, top: int = 20) -> DataFrame:
    """Importance table of a fitted tree ensemble."""
    names = feature_names(model, df)
    weights = model.stages[-1].featureImportances.toArray()
    table = df.sparkSession.createDataFrame(
        [(n, float(w)) for n, w in zip(names, weights)], "feature string, importance double")
    return importance_shares(table, top)
