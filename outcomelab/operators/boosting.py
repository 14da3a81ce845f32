"""Second-order boosted trees for a 0/1 outcome, grown best leaf first.

A tree level costs one job: rows are led to their leaf by a row-local expression over
binned features, gradient and hessian sums by (leaf, feature, bin) are combined before
their shuffle, and a window over those few sums finds every leaf's best split.  The
driver sees one row per leaf.  Sums are exact integers (a gradient is rounded to
1 / ``SCALE``), so a tree does not depend on how the rows are dealt out.

Missing values have a bin of their own, and every split learns the side they go to.
Rows flagged as validation steer only when to stop: after ``patience`` rounds without a
better value the model returns to its best round.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import number
from ..session import cut_lineage
from .evaluate import roc_auc
from .model import importance_shares, use_checkpoints
from .ordering import quantiles
from .split import row_hash

#: A row's gradient is rounded to a multiple of 1 / SCALE; 1e11 rows of weight 80 still fit a long.
SCALE = 1 << 20
#: Rounds after which the margins are written out, so that a lost executor costs few of them.
ROUNDS_KEPT = 20


@dataclass(frozen=True)
class BoostParams:
    """How trees are grown; names follow what they limit."""

    rounds: int = 200
    patience: int = 50
    leaves: int = 31
    depth: int = 12
    rate: float = 0.1
    l1: float = 0.0
    l2: float = 0.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    min_gain: float = 0.0
    feature_share: float = 1.0
    row_share: float = 1.0
    bins: int = 64
    metric: str = "auc"
    seed: int = 42


@dataclass
class Node:
    """A node of a tree; ``best`` is its split, None if it has no good one."""

    number: int
    depth: int
    grad: float
    hess: float
    rows: int
    best: dict | None = None
    known: bool = False


@dataclass
class Boosted:
    """A fitted model: bin edges, the trees kept, and the validation value after each round."""

    features: list[str]
    edges: dict[str, list[float]]
    base: float
    trees: list[list[dict]]
    history: list[float] = field(default_factory=list)
    best_round: int = 0
    params: dict = field(default_factory=dict)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` with the probability of the outcome; a row-local projection.  Unknown values go
        where the split sent missing ones."""
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _leaf_value(tree, lambda split: _raw_side(split, self.features, self.edges))
        return df.withColumn(out, 1 / (1 + F.exp(-total)))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """``tree, node, feature, threshold, missing_left, gain, rows, value``, a row per node."""
        rows = [(t, n["node"], None if n["feature"] is None else self.features[n["feature"]],
                 None if n["feature"] is None else _threshold(n, self.features, self.edges),
                 n["missing_left"], n["gain"], n["rows"], n["value"])
                for t, tree in enumerate(self.trees) for n in tree]
        return spark.createDataFrame(rows, "tree int, node long, feature string, threshold double, "
                                           "missing_left boolean, gain double, rows long, value double")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Boosted:
        return Boosted(**json.loads(text))


def save_boosted(model: Boosted, path: str, spark: SparkSession) -> None:
    spark.createDataFrame([(model.to_json(),)], "value string").write.mode("overwrite").text(path)


def load_boosted(path: str, spark: SparkSession) -> Boosted:
    return Boosted.from_json(spark.read.text(path).first()["value"])


# --- bins and splits ------------------------------------------------------------

def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Exact inner quantiles per feature, repeated ones dropped."""
    found = quantiles(df, features, [i / bins for i in range(1, bins)])
    return {c: sorted({v for v in found[(None, c)] if v is not None}) for c in features}


def with_bins(df: DataFrame, features: Sequence[str], edges: Mapping[str, Sequence[float]],
              out: str = "bins") -> DataFrame:
    """Append an array: 0 for a missing value, else 1 + the number of edges below it.

    A bucketizer closes its buckets on the left, so negated values are looked up among
    negated edges: those at or above the value are counted.
    """
    inputs, buckets = ([f"__{k}{i}" for i in range(len(features))] for k in "xb")
    finite = [sorted(0.0 - e for e in edges[c] if math.isfinite(e)) for c in features]
    rows = df.withColumns({n: number(c) for n, c in zip(inputs, features)})
    searched = [i for i, own in enumerate(finite) if own]
    if searched:
        rows = rows.withColumns({f"{inputs[i]}_in": F.coalesce(0.0 - F.col(inputs[i]), F.lit(0.0)) for i in searched})
        rows = Bucketizer(splitsArray=[[-math.inf, *finite[i], math.inf] for i in searched],
                          inputCols=[f"{inputs[i]}_in" for i in searched],
                          outputCols=[buckets[i] for i in searched]).transform(rows)

    def bin_(i: int) -> Column:
        below = len(finite[i]) + 1 - F.col(buckets[i]) if finite[i] else F.lit(1)
        if -math.inf in edges[features[i]]:
            below = below + (F.col(inputs[i]) > -math.inf).cast("int")
        return F.when(F.col(inputs[i]).isNull(), F.lit(0)).otherwise(below).cast("smallint")

    return rows.select(*[F.col(f"`{c}`") for c in df.columns], F.array(*map(bin_, range(len(features)))).alias(out))


def _threshold(split: Mapping, features: Sequence[str], edges: Mapping[str, list[float]]) -> float:
    """The largest value that goes left; infinity where only missing values go right."""
    own = edges[features[split["feature"]]]
    return own[split["bin"] - 1] if split["bin"] <= len(own) else math.inf


def _binned_side(split: Mapping) -> Column:
    b = F.get("bins", F.lit(split["feature"]))
    return (b <= split["bin"]) & (b > 0) if not split["missing_left"] else b <= split["bin"]


def _raw_side(split: Mapping, features: Sequence[str], edges: Mapping[str, list[float]]) -> Column:
    x = number(features[split["feature"]])
    return F.when(x.isNull(), F.lit(split["missing_left"])).otherwise(
        x <= F.lit(_threshold(split, features, edges)))


def _leaf_value(tree: list[dict], side: Callable[[Mapping], Column]) -> Column:
    nodes = {n["node"]: n for n in tree}

    def at(k: int) -> Column:
        n = nodes[k]
        return F.lit(n["value"]) if n["feature"] is None else \
            F.when(side(n), at(2 * k)).otherwise(at(2 * k + 1))

    return at(1)


def histograms(rows: DataFrame, *keys: str) -> DataFrame:
    """Integer sums ``g, h, n`` by the keys, feature number and bin of rows with ``bins, g, h``."""
    return (rows.select(*keys, "g", "h", F.posexplode("bins").alias("feature", "bin"))
            .groupBy(*keys, "feature", "bin")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")))


def split_gains(hist: DataFrame, p: BoostParams, *keys: str) -> DataFrame:
    """Every cut of every feature with both sides for missing values: sums of both sides and the gain.

    ``bin`` is the last one that goes left.  Cuts that leave a side with too few rows or too
    little hessian have a null gain.
    """
    parts = ", ".join([*keys, "feature"])

    def worth(side: str) -> str:
        g, h = f"(g_{side} / {float(SCALE)}D)", f"(h_{side} / {float(SCALE)}D)"
        kept = f"greatest(abs({g}) - {float(p.l1)!r}D, 0D)" if p.l1 else f"abs({g})"
        return f"coalesce(try_divide({kept} * {kept}, {h} + {float(p.l2)!r}D), 0D)"

    each = lambda text: ", ".join(text.format(c=c) for c in "ghn")
    good = " AND ".join(f"n_{s} >= {max(1, p.min_rows)} AND h_{s} >= {p.min_hessian * SCALE!r}D" for s in ("left", "right"))
    return hist.sparkSession.sql(f"""
        WITH sums AS (
          SELECT {parts}, bin, {each('sum({c}) OVER whole AS {c}_all')},
                 {each('coalesce(max(CASE WHEN bin = 0 THEN {c} END) OVER whole, 0) AS {c}_missing')},
                 {each('sum(CASE WHEN bin > 0 THEN {c} ELSE 0 END) OVER upto AS {c}_present')}
          FROM {{hist}} WINDOW whole AS (PARTITION BY {parts}), upto AS (PARTITION BY {parts} ORDER BY bin
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        sides AS (
          SELECT {parts}, bin, missing_left, {each('{c}_all')},
                 {each('{c}_present + CASE WHEN missing_left THEN {c}_missing ELSE 0 END AS {c}_left')},
                 {each('{c}_all - {c}_present - CASE WHEN missing_left THEN {c}_missing ELSE 0 END AS {c}_right')}
          FROM sums LATERAL VIEW explode(array(true, false)) AS missing_left WHERE bin > 0)
        SELECT *, CASE WHEN {good} THEN {worth('left')} + {worth('right')} - {worth('all')} END AS gain
        FROM sides""", hist=hist)


def best_splits(gains: DataFrame, p: BoostParams, *keys: str) -> DataFrame:
    """The best cut by the keys: largest gain, then the first feature, the first bin, missing left."""
    order = F.struct("gain", -F.col("feature"), -F.col("bin"), "missing_left")
    return gains.where(F.col("gain") > p.min_gain).groupBy(*keys).agg(F.max_by(
        F.struct("feature", "bin", "missing_left", "gain", "g_left", "h_left", "n_left",
                 "g_right", "h_right", "n_right"), order).alias("best"))


# --- growing --------------------------------------------------------------------

def _value(node: Node, p: BoostParams) -> float:
    kept = max(abs(node.grad) - p.l1, 0.0)
    return 0.0 if node.hess + p.l2 <= 0 else -math.copysign(kept, node.grad) / (node.hess + p.l2) * p.rate


class _Tree:
    """A tree that is grown further than needed and cut back to the best leaves."""

    def __init__(self, root: Node, p: BoostParams):
        self.p, self.nodes = p, {1: root}

    def _children(self, k: int) -> list[int]:
        if 2 * k not in self.nodes:
            n, b = self.nodes[k], self.nodes[k].best
            for at, side in ((2 * k, "left"), (2 * k + 1, "right")):
                self.nodes[at] = Node(at, n.depth + 1, b[f"g_{side}"] / SCALE, b[f"h_{side}"] / SCALE,
                                      b[f"n_{side}"], known=n.depth + 1 >= self.p.depth)
        return [2 * k, 2 * k + 1]

    def leaves(self) -> tuple[list[int], bool]:
        """The leaves after splitting the best known leaf again and again; whether that is final."""
        leaves = [1]
        while len(leaves) < self.p.leaves:
            if not all(self.nodes[k].known for k in leaves):
                return leaves, False
            split = [k for k in leaves if self.nodes[k].best]
            if not split:
                break
            k = min(split, key=lambda k: (-self.nodes[k].best["gain"], k))
            at = leaves.index(k)
            leaves[at:at + 1] = self._children(k)
        return leaves, True

    def wanted(self, leaves: list[int]) -> list[int]:
        """Nodes to look at next: the unknown leaves and the children of those that may be split."""
        out = [k for k in leaves if not self.nodes[k].known]
        for k in leaves:
            if self.nodes[k].known and self.nodes[k].best:
                out += [c for c in self._children(k) if not self.nodes[c].known]
        return out

    def place(self, wanted: set[int]) -> Column:
        """The wanted node that a row falls in, null if none."""
        above = {k >> s for k in wanted for s in range(k.bit_length())}

        def at(k: int) -> Column:
            if k in wanted:
                return F.lit(k).cast("long")
            if k not in above:
                return F.lit(None).cast("long")
            return F.when(_binned_side(self.nodes[k].best), at(2 * k)).otherwise(at(2 * k + 1))

        return at(1)

    def rows(self, leaves: list[int]) -> list[dict]:
        """The finished tree as plain rows."""
        kept = sorted({k >> s for k in leaves for s in range(k.bit_length())})
        out = []
        for k in kept:
            n, leaf = self.nodes[k], k in leaves
            b = {} if leaf else n.best
            out.append({"node": k, "feature": b.get("feature"), "bin": b.get("bin"),
                        "missing_left": b.get("missing_left"), "gain": b.get("gain"),
                        "rows": int(n.rows), "value": _value(n, self.p) if leaf else None})
        return out


def grow_tree(rows: DataFrame, p: BoostParams, features: Sequence[int] | None = None) -> list[dict]:
    """One tree for rows with ``bins`` and integer ``g, h``; ``features`` limits the numbers used.

    A table without a good split gives a single leaf, whose sums are not looked up.
    """
    tree = _Tree(Node(1, 0, 0.0, 0.0, 0, known=p.depth < 1), p)
    while True:
        leaves, done = tree.leaves()
        if done:
            return tree.rows(leaves)
        wanted = tree.wanted(leaves)
        placed = rows.withColumn("leaf", tree.place(set(wanted))).where("leaf IS NOT NULL")
        hist = histograms(placed, "leaf")
        if features is not None:
            hist = hist.where(F.col("feature").isin(list(features)))
        # At most leaves x features x bins rows, whatever the table: one task spares two shuffles.
        hist = hist.coalesce(1)
        found = {r["leaf"]: r["best"].asDict() for r in
                 best_splits(split_gains(hist, p, "leaf"), p, "leaf").collect()}
        for k in wanted:
            tree.nodes[k].best, tree.nodes[k].known = found.get(k), True
        if found.get(1):                    # the root's sums are those of its two sides
            b = found[1]
            tree.nodes[1].grad, tree.nodes[1].hess = ((b[f"{c}_left"] + b[f"{c}_right"]) / SCALE for c in "gh")
            tree.nodes[1].rows = b["n_left"] + b["n_right"]


def _metric(table: DataFrame, p: BoostParams) -> float:
    """The validation value, larger is better."""
    held = table.where("held")
    if p.metric == "auc":
        return float(roc_auc(held, "y", "margin").first()["auc"] or 0.5)
    m = F.col("margin")
    loss = F.log1p(F.exp(-F.abs(m))) + F.greatest(m, F.lit(0.0)) - m * F.col("y")
    return -float(held.agg((F.sum(loss * F.col("w")) / F.sum("w")).alias("v")).first()["v"] or 0.0)


def gradients(table: DataFrame) -> DataFrame:
    """Integer gradients ``g`` and hessians ``h`` of the logistic loss at ``margin``."""
    prob = 1 / (1 + F.exp(-F.col("margin")))
    whole = lambda c: F.round(c * F.col("w") * SCALE).cast("long")
    return table.withColumns({"g": whole(prob - F.col("y")), "h": whole(prob * (1 - prob))})


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, params: BoostParams | None = None,
                validation: str | None = None, weight: str | None = None, id_column: str | None = None,
                edges: Mapping[str, list[float]] | None = None,
                after_round: Callable[[int, float], bool] | None = None) -> Boosted:
    """Fit boosted trees.

    Rows without a 0/1 label are left out.  ``validation`` names a boolean column; its rows
    take no part in bins, sums or the base rate.  ``id_column`` is needed for ``row_share``
    below 1: a row is in a tree's sample by the hash of its id, so a replay draws the same.
    ``after_round(round, value)`` may return True to give up (pruned search); ``edges`` are
    bin edges found before.  An empty table gives a model without trees.
    """
    p = params or BoostParams()
    if p.row_share < 1 and not id_column:
        raise ValueError("row_share needs an id column")
    if p.metric not in ("auc", "loss"):
        raise ValueError(f"unknown metric {p.metric!r}: use auc or loss")
    use_checkpoints(df)
    features = list(features)
    held = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    df = df.where(F.col(label).isin(0, 1))
    edges = dict(edges or bin_edges(df.where(~held), features, p.bins))
    y = F.col(label).cast("double")
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    table = with_bins(df, features, edges, "__bins").select(
        y.alias("y"), w.alias("w"), held.alias("held"),
        *([row_hash(id_column, p.seed).alias("key")] if p.row_share < 1 else []),
        F.col("__bins").alias("bins"))
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    sums = table.where("NOT held").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("y")).first()
    share = min(max((sums["y"] or 0.0) / sums["w"], 1e-6), 1 - 1e-6) if sums["w"] else 0.5
    base = math.log(share / (1 - share))
    model = Boosted(features, edges, base, [], params=asdict(p))
    first = table
    table = table.withColumn("margin", F.lit(base)).persist(StorageLevel.MEMORY_AND_DISK)
    best = None
    try:
        for t in range(p.rounds if sums["w"] else 0):
            rng = random.Random(p.seed * 1_000_003 + t)
            chosen = sorted(rng.sample(range(len(features)), max(1, round(p.feature_share * len(features))))) \
                if p.feature_share < 1 else None
            rows = gradients(table.where("NOT held"))
            if p.row_share < 1:
                draw = F.conv(F.substring(F.md5(F.concat("key", F.lit(f"|{t}"))), 1, 12), 16, 10).cast("double")
                rows = rows.where(draw < p.row_share * float(1 << 48))
            tree = grow_tree(rows, p, chosen)
            if len(tree) == 1:
                break                                   # no split is left that gains anything
            model.trees.append(tree)
            further = table.withColumn("margin", F.col("margin") + _leaf_value(tree, _binned_side))
            if (t + 1) % ROUNDS_KEPT == 0:
                further = cut_lineage(further)
            further = further.persist(StorageLevel.MEMORY_AND_DISK)
            if validation:
                model.history.append(_metric(further, p))
                if best is None or model.history[-1] > best:
                    best, model.best_round = model.history[-1], t + 1
            else:
                further.count()
                model.best_round = t + 1
            table.unpersist()
            table = further
            if validation and (t + 1 - model.best_round >= p.patience
                               or (after_round and after_round(t + 1, model.history[-1]))):
                break
    finally:
        table.unpersist()
        first.unpersist()
    model.trees = model.trees[:model.best_round]
    return model


# --- importance -----------------------------------------------------------------

def node_importance(nodes: DataFrame, by: str = "gain") -> DataFrame:
    """``feature, importance, share_pct, cum_pct, splits`` of a node table, best first.

    ``by``: ``gain`` (summed over the splits) or ``split`` (their number).
    """
    used = nodes.where("feature IS NOT NULL").groupBy("feature").agg(
        F.sum("gain").alias("total"), F.count(F.lit(1)).alias("splits"))
    ranked = used.select("feature", F.col("total" if by == "gain" else "splits").cast("double").alias("importance"),
                         "splits")
    shares = importance_shares(ranked.drop("splits"), 10_000)
    return shares.join(ranked.select("feature", "splits"), "feature").select(
        "feature", "importance", "share_pct", "cum_pct", "splits")


def ensemble_nodes(model, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """The node table of a fitted Spark tree ensemble: ``tree, node, feature, gain, rows``.

    ``gain`` is the impurity lost at the split times its rows, comparable between nodes;
    leaves have neither feature nor gain.
    """
    rows = []
    for t, tree in enumerate(model.trees):
        stack = [(1, tree._java_obj.rootNode() if hasattr(tree, "_java_obj") else tree._call_java("rootNode"))]
        while stack:
            k, node = stack.pop()
            n = float(node.impurityStats().count())
            inner = node.getClass().getSimpleName() == "InternalNode"
            rows.append((t, k, names[node.split().featureIndex()] if inner else None,
                         float(node.gain()) * n if inner else None, n))
            if inner:
                stack += [(2 * k, node.leftChild()), (2 * k + 1, node.rightChild())]
    return spark.createDataFrame(rows, "tree int, node long, feature string, gain double, rows double")
