"""Search for parameters of boosted trees: a Parzen sampler, pruned trials and a stepwise tuner.

The driver holds the trial table only (settings and one value a round); every trial is a
distributed fit.  Trials are seeded by their number, so the same results lead to the same
next settings, also after a stop and a reload of the table.
"""

from __future__ import annotations

import json
import math
import random
import statistics
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from .boosting import Boosted, BoostParams, bin_edges, fit_boosted
from .model import draw

# Ranges of the boosted search.
BOOST_SPACE: dict[str, tuple] = {
    "leaves": ("int", 10, 300), "depth": ("int", 3, 12), "rate": ("log", 0.01, 0.3),
    "feature_share": ("float", 0.5, 1.0), "row_share": ("float", 0.5, 1.0),
    "min_rows": ("int", 5, 100), "l1": ("float", 0.0, 10.0), "l2": ("float", 0.0, 10.0),
}
#: Draws of a trial's setting among which the best expected gain is taken.
CANDIDATES = 24
GOOD_SHARE, MOST_GOOD = 0.1, 25


@dataclass
class Trial:
    """One setting; ``values`` after each round, ``state`` open, done or pruned."""

    number: int
    params: dict
    values: list[float] = field(default_factory=list)
    value: float | None = None
    state: str = "open"


class _Parzen:
    """A density of one parameter: a bump at every observation and a wide one over the range."""

    def __init__(self, kind: str, limits: Sequence, seen: Sequence):
        self.kind, self.limits = kind, limits
        if kind == "choice":
            weights = [1.0 + sum(v == c for v in seen) for c in limits]
            self.weights = [w / sum(weights) for w in weights]
            return
        self.low, self.high = (math.log(x) for x in limits) if kind == "log" else limits
        if kind == "int":
            self.low, self.high = self.low - 0.5, self.high + 0.5
        width = self.high - self.low
        points = sorted(math.log(v) if kind == "log" else v for v in seen)
        around = [self.low, *points, self.high]
        least = width / min(100, len(points) + 2)
        self.bumps = [((self.low + self.high) / 2, width)] + [
            (p, min(width, max(least, p - around[i], around[i + 2] - p))) for i, p in enumerate(points)]

    def sample(self, rng: random.Random):
        if self.kind == "choice":
            return rng.choices(self.limits, self.weights)[0]
        centre, spread = rng.choice(self.bumps)
        while True:
            x = rng.gauss(centre, spread)
            if self.low <= x <= self.high:
                break
        if self.kind == "int":
            return min(max(round(x), self.limits[0]), self.limits[1])
        return min(max(math.exp(x) if self.kind == "log" else x, self.limits[0]), self.limits[1])

    def density(self, value) -> float:
        if self.kind == "choice":
            return self.weights[list(self.limits).index(value)]
        x = math.log(value) if self.kind == "log" else value
        below = lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2)))
        total = 0.0
        for centre, spread in self.bumps:
            inside = below((self.high - centre) / spread) - below((self.low - centre) / spread)
            total += math.exp(-((x - centre) / spread) ** 2 / 2) / (spread * inside)
        return total / len(self.bumps)


class Study:
    """Asks for settings and is told values, larger ones being better.

    The first ``startup`` trials are drawn evenly.  Later ones take, for each parameter,
    the draw with the largest ratio of the density of good trials to that of the others.
    Settings asked for together do not see each other's values.
    """

    def __init__(self, space: Mapping[str, tuple], seed: int = 42, startup: int = 10, prune: bool = False,
                 warm_trials: int = 5, warm_rounds: int = 0):
        self.space, self.seed, self.startup = {k: tuple(v) for k, v in space.items()}, seed, startup
        self.prune, self.warm_trials, self.warm_rounds = prune, warm_trials, warm_rounds
        self.trials: list[Trial] = []

    def ask(self) -> Trial:
        number = len(self.trials)
        rng = random.Random(self.seed * 1_000_003 + number)
        told = sorted((t for t in self.trials if t.value is not None), key=lambda t: (-t.value, t.number))
        if len(told) < self.startup:
            params = draw(self.space, 1, rng.randrange(1 << 30))[0]
        else:
            n = min(max(1, math.ceil(GOOD_SHARE * len(told))), MOST_GOOD)
            params = {}
            for name, (kind, *limits) in self.space.items():
                good, other = (_Parzen(kind, limits, [t.params[name] for t in part]) for part in (told[:n], told[n:]))
                drawn = [good.sample(rng) for _ in range(CANDIDATES)]
                params[name] = max(drawn, key=lambda v: good.density(v) / other.density(v))
        self.trials.append(Trial(number, params))
        return self.trials[-1]

    def hopeless(self, trial: Trial, value: float) -> bool:
        """Note a round's value; whether the trial's best so far is under the median of the others there."""
        trial.values.append(value)
        at = len(trial.values)
        others = [t.values[at - 1] for t in self.trials if t.state == "done" and len(t.values) >= at]
        return (self.prune and at > self.warm_rounds and len(others) >= self.warm_trials
                and max(trial.values) < statistics.median(others))

    def tell(self, trial: Trial, value: float, pruned: bool = False) -> None:
        trial.value, trial.state = value, "pruned" if pruned else "done"

    @property
    def best(self) -> Trial:
        """The best finished trial, the first among equals."""
        return max((t for t in self.trials if t.state == "done"), key=lambda t: (t.value, -t.number))

    def log(self, spark: SparkSession) -> DataFrame:
        """``trial, params, value, state, rounds, values``."""
        return spark.createDataFrame(
            [(t.number, {k: str(v) for k, v in t.params.items()}, t.value, t.state, len(t.values), t.values)
             for t in self.trials],
            "trial int, params map<string,string>, value double, state string, rounds int, values array<double>")

    def to_json(self) -> str:
        return json.dumps({"space": self.space, "seed": self.seed, "startup": self.startup, "prune": self.prune,
                           "warm_trials": self.warm_trials, "warm_rounds": self.warm_rounds,
                           "trials": [asdict(t) for t in self.trials if t.state != "open"]})

    @staticmethod
    def from_json(text: str) -> Study:
        kept = json.loads(text)
        trials = kept.pop("trials")
        study = Study(**kept)
        study.trials = [Trial(**t) for t in trials]
        return study


def _saved(study: Study, path: str, spark: SparkSession) -> None:
    spark.createDataFrame([(study.to_json(),)], "value string").write.mode("overwrite").text(path)


def load_study(path: str, spark: SparkSession) -> Study:
    return Study.from_json(spark.read.text(path).first()["value"])


def tune_boosted(df: DataFrame, features: Sequence[str], label: str, validation: str, study: Study, n_trials: int,
                 base: BoostParams | None = None, weight: str | None = None, id_column: str | None = None,
                 path: str | None = None) -> tuple[BoostParams, Study]:
    """Run the study's trials until it has ``n_trials``; returns the best setting.

    Bins are found once for all trials.  A trial's value is that of its best round on the
    validation rows.  With ``path`` the trial table is written after every trial, so a
    stopped search goes on with ``load_study``.
    """
    base = base or BoostParams()
    df = df.persist()
    try:
        edges = bin_edges(df.where(f"NOT coalesce(`{validation}`, false)"), features, base.bins)
        while len(study.trials) < n_trials:
            trial = study.ask()
            cut: list[int] = []

            def after(at: int, value: float, trial=trial, cut=cut) -> bool:
                if study.hopeless(trial, value):
                    cut.append(at)
                return bool(cut)

            model: Boosted = fit_boosted(df, features, label, replace(base, **trial.params), validation, weight,
                                         id_column, edges, after)
            study.tell(trial, max(model.history) if model.history else -math.inf, bool(cut))
            if path:
                _saved(study, path, df.sparkSession)
    finally:
        df.unpersist()
    return replace(base, **study.best.params), study


# --- stepwise ---------------------------------------------------------------------

Stage = tuple[str, Callable[[Mapping, random.Random], list[dict]]]

# Parameter groups in order, and the settings tried in each.
BOOST_STAGES: list[Stage] = [
    ("feature_share", lambda best, rng: [{"feature_share": 0.4 + 0.1 * i} for i in range(7)]),
    ("leaves", lambda best, rng: [{"leaves": rng.randint(2, 256)} for _ in range(20)]),
    ("rows", lambda best, rng: [{"row_share": rng.uniform(0.4, 1.0)} for _ in range(10)]),
    ("feature_share_fine", lambda best, rng: [
        {"feature_share": min(1.0, max(0.4, best.get("feature_share", 1.0) + d))}
        for d in (-0.08, -0.048, -0.016, 0.016, 0.048, 0.08)]),
    ("penalties", lambda best, rng: [
        {"l1": math.exp(rng.uniform(math.log(1e-8), math.log(10))), "l2": math.exp(rng.uniform(math.log(1e-8), math.log(10)))}
        for _ in range(20)]),
    ("min_rows", lambda best, rng: [{"min_rows": n} for n in (5, 10, 25, 50, 100)]),
]


def tune_stepwise(evaluate: Callable[[dict], float], start: Mapping, stages: Sequence[Stage] = tuple(BOOST_STAGES),
                  budget: float | None = None, seed: int = 42,
                  clock: Callable[[], float] = time.monotonic) -> tuple[dict, list[tuple]]:
    """Tune one parameter group after the other, each with the best of those before.

    Returns the best setting and the log ``(stage, step, params, value, best so far)``.  Once
    ``budget`` seconds have passed no further setting is tried.  The start itself is
    evaluated first; an equal value does not replace the best.
    """
    began = clock()
    best, value = dict(start), evaluate(dict(start))
    log = [("start", 0, dict(start), value, value)]
    for name, settings in stages:
        carried = dict(best)
        for step, setting in enumerate(settings(carried, random.Random(f"{seed}|{name}"))):
            if budget is not None and clock() - began >= budget:
                return best, log
            tried = {**carried, **setting}
            found = evaluate(tried)
            if found > value:
                best, value = tried, found
            log.append((name, step, tried, found, value))
    return best, log


def tune_boosted_stepwise(df: DataFrame, features: Sequence[str], label: str, validation: str,
                          base: BoostParams | None = None, id_column: str | None = None,
                          stages: Sequence[Stage] = tuple(BOOST_STAGES), budget: float | None = None,
                          clock: Callable[[], float] = time.monotonic) -> tuple[BoostParams, DataFrame]:
    """The stepwise tuner over boosted trees; bins and rows are prepared once.

    Returns the best setting and the log ``stage, step, params, value, best``.
    """
    base = base or BoostParams()
    df = df.persist()
    try:
        edges = bin_edges(df.where(f"NOT coalesce(`{validation}`, false)"), features, base.bins)

        def evaluate(params: dict) -> float:
            model = fit_boosted(df, features, label, replace(base, **params), validation, None, id_column, edges)
            return max(model.history) if model.history else -math.inf

        best, log = tune_stepwise(evaluate, {}, stages, budget, base.seed, clock)
    finally:
        df.unpersist()
    rows = [(s, i, {k: str(v) for k, v in p.items()}, v, b) for s, i, p, v, b in log]
    return replace(base, **best), df.sparkSession.createDataFrame(
        rows, "stage string, step int, params map<string,string>, value double, best double")
