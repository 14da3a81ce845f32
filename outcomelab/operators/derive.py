"""Derived columns from a declarative recipe.

A recipe is a list of ``Step``.  A step names its output, the columns it needs,
and builds one column expression; it is skipped when a needed column is absent,
and a step may use the output of an earlier one.  The whole recipe becomes a
single projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as E
from .ordering import quantiles

Columns = Mapping[str, Column]
Thresholds = Mapping[str, float | None]


@dataclass(frozen=True)
class Step:
    output: str
    needs: tuple[str, ...]
    build: Callable[[Columns, Thresholds], Column]
    # Quantiles that must be fitted first: column -> probability.
    quantile_of: Mapping[str, float] = field(default_factory=dict)


def threshold_key(column: str, prob: float) -> str:
    return f"{column}@{prob}"


def blend(output: str, **weights: float) -> Step:
    return Step(output, tuple(weights),
                lambda c, _: E.weighted_sum([(c[k], w) for k, w in weights.items()]))


def total(output: str, *terms: str) -> Step:
    return blend(output, **{t: 1.0 for t in terms})


def ratio(output: str, num: str, den: str, guard: float) -> Step:
    return Step(output, (num, den), lambda c, _: E.guarded_ratio(c[num], c[den], guard))


def product(output: str, left: str, right: str) -> Step:
    return Step(output, (left, right), lambda c, _: c[left] * c[right])


def copy(output: str, source: str) -> Step:
    return Step(output, (source,), lambda c, _: c[source].cast("double"))


def log_volume(output: str, rate: str, volume: str) -> Step:
    return Step(output, (rate, volume), lambda c, _: c[rate] * F.log1p(c[volume]))


def to_number(output: str, source: str) -> Step:
    return Step(output, (source,), lambda c, _: E.parse_number(c[source]))


def presence(output: str, source: str) -> Step:
    return Step(output, (source,), lambda c, _: E.flag(c[source].isNotNull()))


def member(output: str, source: str, values: Sequence[str]) -> Step:
    return Step(output, (source,), lambda c, _: E.flag(c[source].isin(list(values))))


def level(output: str, source: str, levels: Mapping[str, int]) -> Step:
    return Step(output, (source,), lambda c, _: E.ordinal(c[source], levels))


def all_above(output: str, among: tuple[str, Sequence[str]] | None = None,
              quantile: Mapping[str, float] | None = None, **limits: float) -> Step:
    """Flag: every column above its limit or fitted quantile, inside a set of levels."""
    return _comparison(output, among, quantile or {}, limits, every=True)


def any_above(output: str, quantile: Mapping[str, float] | None = None, **limits: float) -> Step:
    return _comparison(output, None, quantile or {}, limits, every=False)


def _comparison(output: str, among: tuple[str, Sequence[str]] | None,
                quantile: Mapping[str, float], limits: Mapping[str, float], every: bool) -> Step:
    def build(c: Columns, thresholds: Thresholds) -> Column:
        tests = [c[k] > F.lit(v) for k, v in limits.items()]
        for k, p in quantile.items():
            limit = thresholds[threshold_key(k, p)]
            tests.append(F.lit(False) if limit is None else c[k] > F.lit(limit))
        tests = [F.coalesce(t, F.lit(False)) for t in tests]
        if among:
            tests.append(F.coalesce(c[among[0]].isin(list(among[1])), F.lit(False)))
        joined = tests[0]
        for t in tests[1:]:
            joined = (joined & t) if every else (joined | t)
        return E.flag(joined)

    needs = (*([among[0]] if among else ()), *quantile, *limits)
    return Step(output, needs, build, dict(quantile))


def usable(columns: Sequence[str], recipe: Sequence[Step]) -> list[Step]:
    """Steps whose inputs exist, in order; the first usable step of a name wins."""
    known, done, out = set(columns), set(), []
    for step in recipe:
        if step.output not in done and all(n in known for n in step.needs):
            out.append(step)
            done.add(step.output)
            known.add(step.output)
    return out


def fit_thresholds(df: DataFrame, recipe: Sequence[Step]) -> dict[str, float | None]:
    """Exact quantiles of the fitting table that the recipe's flags compare with."""
    wanted: dict[float, list[str]] = {}
    for step in usable(df.columns, recipe):
        for c, p in step.quantile_of.items():
            if c not in wanted.setdefault(p, []):
                wanted[p].append(c)
    out: dict[str, float | None] = {}
    columns = sorted({c for cols in wanted.values() for c in cols})
    if not columns:
        return out
    probs = sorted(wanted)
    found = quantiles(df, columns, probs)
    for i, p in enumerate(probs):
        for c in wanted[p]:
            out[threshold_key(c, p)] = found[(None, c)][i]
    return out


def apply_recipe(df: DataFrame, recipe: Sequence[Step],
                 thresholds: Thresholds | None = None) -> DataFrame:
    """Append every derivable column in one projection.

    ``thresholds`` come from ``fit_thresholds`` on the training table, so that
    other tables are judged by the same limits; without them the table is
    fitted on itself.
    """
    steps = usable(df.columns, recipe)
    if thresholds is None:
        thresholds = fit_thresholds(df, recipe)
    known: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    built: dict[str, Column] = {}
    for step in steps:
        built[step.output] = known[step.output] = step.build(known, thresholds)
    return df.withColumns(built)
