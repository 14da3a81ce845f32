"""Exact global order without pulling a table through one task.

Three building blocks, used wherever a rank, a running sum, a quantile or a cut
over the whole table is needed:

* ``running_totals``  collapse equal values with a map-side combine, spread the
  distinct values over monotone buckets, and add per-bucket offsets.
* ``ranked_rows``     the same for rows; a very frequent key is split further by
  the tie-break column so that no bucket holds it whole.
* ``quantiles``       exact order statistics: values are counted between edges that a
  sketch gives, and only buckets with a wanted rank are looked into; only edges and
  counts reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.expr import literal_array, number
from ..session import HELD

BUCKET = "__bucket"
MAX_BUCKETS = 8192
#: A sketch of a whole table is merged in at most so many tasks.
SKETCH_TASKS = 32


def default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(4 * parts, MAX_BUCKETS))


def sketch_edges(df: DataFrame, key: str, buckets: int) -> tuple[list[float], dict[float, int]]:
    """Ascending bucket edges, and the frequent values with the steps they fill.

    Any monotone edges give a right result, so a sketch is good enough here; it
    only decides how even the buckets are.  A value that fills two or more of
    the equal-count steps is frequent and gets a bucket of its own.

    The more partitions there are the longer it takes to merge their sketches, so they
    are merged in groups, and only the steps of each group reach the driver.
    """
    probs = [i / buckets for i in range(1, buckets)]
    groups = df.groupBy((F.spark_partition_id() % SKETCH_TASKS).alias("__group")).agg(
        F.count(key).alias("n"),
        F.percentile_approx(key, literal_array(probs), 20 * buckets).alias("e")).collect()
    steps = Counter(pooled_steps([(r["n"], r["e"]) for r in groups if r["e"]], buckets))
    frequent = {v: n for v, n in steps.items() if n > 1}
    ends = set(steps) | {math.nextafter(v, math.inf) for v in frequent}
    return sorted(e for e in ends if math.isfinite(e)), frequent


def pooled_steps(groups: Iterable[tuple[int, Sequence[float]]], buckets: int) -> list[float]:
    """Equal-count steps of all rows, from the number of rows and the steps of each group."""
    values = sorted((float(v), n) for n, steps in groups for v in steps)
    total, below, out = sum(n for _, n in values), 0, []
    for v, n in values:
        below += n
        while len(out) < buckets - 1 and below * buckets >= (len(out) + 1) * total:
            out.append(v)
    return out


def with_bucket(df: DataFrame, key: str, edges: Sequence[float], out: str = BUCKET) -> DataFrame:
    """Monotone bucket number of a double column, by binary search over the edges."""
    if not edges:
        return df.withColumn(out, F.lit(0.0))
    splits = [-math.inf, *edges, math.inf]
    return Bucketizer(splits=splits, inputCol=key, outputCol=out).transform(df)


def running_totals(df: DataFrame, key: str, measures: Mapping[str, Column],
                   descending: bool = False, buckets: int | None = None,
                   following: bool = False) -> DataFrame:
    """Per distinct key: each measure, its running sum and its grand total.

    Returns ``key, m, m_before, m_total`` for every measure ``m``, where
    ``m_before`` sums the rows with a strictly smaller (or, descending, larger)
    key.  With ``following`` also ``m_next``, the measure at the next key (null at
    the last), which a bucket's last key takes from the next bucket that holds any.
    Rows with a missing key are left out.
    """
    names = list(measures)
    rows = df.select(number(key).alias(key), *[c.alias(m) for m, c in measures.items()])
    rows = rows.where(F.col(key).isNotNull())
    edges, _ = sketch_edges(rows, key, buckets or default_buckets(df))
    values = with_bucket(rows.groupBy(key).agg(*[F.sum(m).alias(m) for m in names]), key, edges)

    direction = F.desc if descending else F.asc
    earlier = Window.orderBy(direction(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(BUCKET).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per bucket: at most len(edges) + 1 rows, whatever the table size.
    first = F.max_by if descending else F.min_by
    onward = Window.orderBy(direction(BUCKET))
    offsets = values.groupBy(BUCKET).agg(
        *[F.sum(m).alias(m) for m in names],
        *[first(m, key).alias(f"{m}_first") for m in names if following]).select(
        BUCKET,
        *[F.lead(f"{m}_first").over(onward).alias(f"{m}_onward") for m in names if following],
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_offset") for m in names],
        *[F.sum(m).over(everything).alias(f"{m}_total") for m in names],
    )
    inside = Window.partitionBy(BUCKET).orderBy(direction(key)).rowsBetween(
        Window.unboundedPreceding, -1)
    return values.join(F.broadcast(offsets), BUCKET).select(
        key,
        *names,
        *[(F.col(f"{m}_offset") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_before")
          for m in names],
        *[f"{m}_total" for m in names],
        *[F.coalesce(F.lead(m).over(Window.partitionBy(BUCKET).orderBy(direction(key))),
                     F.col(f"{m}_onward")).alias(f"{m}_next") for m in names if following],
    )


def ranked_rows(df: DataFrame, key: str, tie: str, out: str = "rank",
                descending: bool = True, buckets: int | None = None) -> DataFrame:
    """Append the 1-based global rank by ``key``, then by ascending numeric ``tie``.

    Missing keys rank last.  A key that fills several steps of the sketch is cut
    along the tie-break column into about as many sub-buckets, so all buckets
    stay even and their number stays below three times ``buckets``.  The table
    is read more than once and must give the same rows each time.
    """
    buckets = buckets or default_buckets(df)
    sub, order_key, tie_key = "__sub", "__key", "__tie"
    value = number(key) if descending else -number(key)
    rows = df.withColumns({
        order_key: F.coalesce(value, F.lit(-math.inf)),
        tie_key: F.col(tie).cast("double"),
    })
    edges, frequent = sketch_edges(rows, order_key, buckets)
    rows = with_bucket(rows, order_key, edges)
    if frequent:
        # The bucket that starts at a frequent value holds nothing else.
        hot = rows.where(F.col(order_key).isin(list(frequent)))
        tie_edges, _ = sketch_edges(hot, tie_key, buckets)
        steps = [0] * (len(edges) + 1)
        for v, n in frequent.items():
            steps[edges.index(v) + 1 if math.isfinite(v) else 0] = n
        share = F.get(F.array(*[F.lit(n) for n in steps]), F.col(BUCKET).cast("int"))
        rows = with_bucket(rows, tie_key, tie_edges, sub).withColumn(
            sub, F.floor(F.col(sub) * share / F.lit(len(tie_edges) + 1)))
    else:
        rows = rows.withColumn(sub, F.lit(0).cast("bigint"))

    earlier = Window.orderBy(F.desc(BUCKET), F.asc(sub)).rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per (bucket, sub-bucket), see above for their number.
    offsets = rows.groupBy(BUCKET, sub).agg(F.count(F.lit(1)).alias("n")).select(
        BUCKET, sub, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(BUCKET, sub).orderBy(
        F.desc(order_key), F.asc(tie_key), F.asc(tie))
    return (rows.join(F.broadcast(offsets), [BUCKET, sub])
            .withColumn(out, F.col("__offset") + F.row_number().over(inside))
            .drop(BUCKET, sub, order_key, tie_key, "__offset"))


def top_rows(df: DataFrame, key: str, tie: str, n: int, out: str = "rank",
             limit: int = 2_000) -> DataFrame:
    """The first ``n`` rows by descending key, ranked; missing keys come last.

    A small ``n`` is a top-k of each task merged once.  For a large one a sketch
    gives a lower bound of the last wanted key, and only rows above it are ranked
    by ``ranked_rows``, so they never meet in one place.
    """
    if n > limit:
        return ranked_rows(_contenders(df, key, n), key, tie, out).where(F.col(out) <= n)
    order = [F.col(key).desc_nulls_last(), F.asc(tie)]
    best = df.orderBy(*order).limit(n)
    return best.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def _contenders(df: DataFrame, key: str, n: int, accuracy: int = 10_000) -> DataFrame:
    """Rows that can be among the best ``n``; the whole table when the sketch cannot tell."""
    total = df.agg(F.count(key).alias("n")).first()["n"]
    share = 1.0 - n / total - 2.0 / accuracy if total else 0.0
    if share <= 0:
        return df
    bound = df.agg(F.percentile_approx(number(key), share, accuracy).alias("b")).first()["b"]
    kept = df.where(F.col(key) >= F.lit(float(bound)))
    enough = kept.agg(F.count(F.lit(1)).alias("n")).first()["n"] >= n
    return kept if enough else df


def _long(rows: DataFrame, by: str | None, columns: Sequence[str],
          edges: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """``by, c, x, b``: a row per value that is there, with its column's number and its bucket."""
    inputs = [f"__x{i}" for i in range(len(columns))]
    out = rows.select(*([by] if by else []), *columns, *[
        (F.coalesce(F.col(c), F.lit(0.0)) + 0.0).alias(i) for c, i in zip(columns, inputs)])      # no -0.0
    buckets = [F.lit(0.0)] * len(columns)
    if edges is not None:
        names = [f"__b{i}" for i in range(len(columns))]
        splits = [[-math.inf, *edges[c], math.inf] for c in columns]
        # A bucketizer needs a split inside; one at 0 does no harm.
        splits = [s if len(s) > 2 else [-math.inf, 0.0, math.inf] for s in splits]
        out = Bucketizer(splitsArray=splits, inputCols=inputs, outputCols=names).transform(out)
        buckets = [F.col(b) for b in names]
    values = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).alias("x"), b.cast("int").alias("b"))
                       for i, (c, b) in enumerate(zip(columns, buckets))])
    return out.select(*([by] if by else []), F.inline(values)).where("x IS NOT NULL")


def _edges_around(values: Sequence[float]) -> set[float]:
    """Edges that give each of the values a bucket of its own."""
    ends = {e for v in values
            for e in ([math.nextafter(v, -v)] if math.isinf(v) else [v, math.nextafter(v, math.inf)])}
    return {e + 0.0 for e in ends if math.isfinite(e)}


def _refine(rows: DataFrame, by: str | None, columns: Sequence[str], edges: dict[str, list[float]],
            open_buckets: set[tuple[int, int]], accuracy: int) -> bool:
    """Cut the open buckets at values of a sketch of each; whether any was cut.

    The sketch of a column is merged in a task of its own, so no task reads those of all.
    """
    steps = max(2, accuracy // 4)
    probs = literal_array([i / steps for i in range(1, steps)])
    long = _long(rows, by, columns, edges)
    if any(edges.values()):
        width = 1 + max(map(len, edges.values()))
        long = long.where((F.col("c") * width + F.col("b")).isin([c * width + b for c, b in open_buckets]))
    before = sum(map(len, edges.values()))
    for row in long.groupBy("c", "b").agg(F.percentile_approx("x", probs, accuracy).alias("e")).collect():
        c = columns[row["c"]]
        edges[c] = sorted({*edges[c], *_edges_around([float(v) for v in row["e"]])})
    return sum(map(len, edges.values())) > before


def _order_statistics(rows: DataFrame, by: str | None, columns: Sequence[str],
                      ranks: Mapping[tuple[object, str], set[int]], budget: int,
                      accuracy: int, outside: bool = False) -> dict[tuple[object, str, int], float]:
    """The values at 0-based ranks among the non-missing ones, by ``(group, column, rank)``.

    With ``outside`` a group stands for the rows of all other groups.  Values are counted in buckets between edges that a sketch of each column gives; buckets
    with a wanted rank and more than ``budget`` rows are cut further.  The values of the wanted
    buckets are counted and ranked bucket by bucket, spread over the tasks.
    """
    keys = [by] if by else []
    edges: dict[str, list[float]] = {c: [] for c in columns}
    open_buckets = {(i, 0) for i in range(len(columns))}
    while True:
        cut = _refine(rows, by, columns, edges, open_buckets, accuracy)
        counts: dict[tuple[object, str], list[tuple[int, int]]] = {}
        for row in (_long(rows, by, columns, edges).groupBy(*keys, "c", "b")
                    .agg(F.count(F.lit(1)).alias("n")).collect()):
            counts.setdefault((row[by] if by else None, columns[row["c"]]), []).append((row["b"], row["n"]))
        if outside:
            counts = _outside(counts, ranks)
        found: dict[tuple[object, str, int], float] = {}
        wanted: list[tuple[object, int, int, int, int]] = []        # group, column, bucket, rank, rank inside
        open_buckets = set()
        for (group, c), wanted_ranks in ranks.items():
            own, steps, below = edges[c], iter(sorted(counts[(group, c)])), 0
            b, n = next(steps)
            for rank in sorted(wanted_ranks):
                while rank >= below + n:
                    below += n
                    b, n = next(steps)
                if 0 < b < len(own) and own[b] == math.nextafter(own[b - 1], math.inf):
                    found[(group, c, rank)] = own[b - 1]            # no other value fits in
                else:
                    wanted.append((group, columns.index(c), b, rank, rank - below))
                    if n > budget:
                        open_buckets.add((columns.index(c), b))
        if not open_buckets or not cut:
            break
    if not wanted:
        return found
    # A row per rank: no more than twice the probabilities, columns and groups.
    schema = "c int, b int, rank long, inside long"
    asked = rows.sparkSession.createDataFrame([(*([g] if by else []), *rest) for g, *rest in wanted], StructType(
        [*([StructField("__group", rows.schema[by].dataType)] if by else []), *StructType.fromDDL(schema)]))
    width = 1 + max(map(len, edges.values()))
    held = _long(rows, by, columns, edges).where(
        (F.col("c") * width + F.col("b")).isin(sorted({c * width + b for _, c, b, _, _ in wanted})))
    inside = Window.partitionBy(*keys, "c", "b").orderBy("x").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    values = held.groupBy(*keys, "c", "b", "x").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "upto", F.sum("n").over(inside)) if not outside else \
        _values_outside(held, by, sorted({g for g, *_ in wanted}))
    same = (values["c"] == asked["c"]) & (values["b"] == asked["b"])
    if by:
        same = same & (values[by] == asked["__group"])
    hits = values.join(F.broadcast(asked), same & (asked["inside"] < values["upto"])
                       & (asked["inside"] >= values["upto"] - values["n"]))
    for row in hits.select(*([asked["__group"]] if by else []), asked["c"], "rank", "x").collect():
        found[(row["__group"] if by else None, columns[row["c"]], row["rank"])] = float(row["x"])
    return found


def _outside(counts: Mapping[tuple[object, str], Sequence[tuple[int, int]]],
             wanted: Iterable[tuple[object, str]]) -> dict[tuple[object, str], list[tuple[int, int]]]:
    """Rows by bucket outside each group, from the rows by bucket of every group."""
    totals: dict[str, Counter] = {}
    for (_, c), steps in counts.items():
        totals.setdefault(c, Counter()).update(dict(steps))
    out = {}
    for group, c in wanted:
        own = dict(counts.get((group, c), []))
        out[(group, c)] = [(b, n - own.get(b, 0)) for b, n in totals[c].items()]
    return out


def _values_outside(held: DataFrame, by: str, groups: Sequence[object]) -> DataFrame:
    """``by, c, b, x, n, upto``: distinct values with their rows outside each group."""
    others = [f"__n{i}" for i in range(len(groups))]
    counted = held.groupBy("c", "b", "x").agg(
        *[F.count_if(F.col(by) != F.lit(g)).alias(n) for g, n in zip(groups, others)])
    inside = Window.partitionBy("c", "b").orderBy("x").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = counted.withColumns({f"{n}_upto": F.sum(n).over(inside) for n in others})
    return summed.select("c", "b", "x", F.inline(F.array(*[
        F.struct(F.lit(g).cast(held.schema[by].dataType).alias(by), F.col(n).alias("n"), F.col(f"{n}_upto").alias("upto"))
        for g, n in zip(groups, others)]))).where("n > 0")


def quantiles_outside(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str,
                      budget: int = 500_000, accuracy: int = 2_000, batch: int = 40
                      ) -> dict[tuple[object, str], list[float | None]]:
    """``quantiles`` of the rows outside each group of ``by``, as a fold's training rows are.

    Rows without a group are left out.  Larger columns are sketched and counted once for all
    groups: what lies outside a group is the whole less the group.
    """
    columns = list(columns)
    rows = df.select(by, *[number(c).alias(c) for c in columns]).where(F.col(by).isNotNull())
    rows = rows.persist(HELD)
    try:
        own = {r[by]: r for r in rows.groupBy(by).agg(*[F.count(c).alias(c) for c in columns]).collect()}
        sizes = {(g, c): sum(r[c] for r in own.values()) - own[g][c] for g in own for c in columns}
        result: dict[tuple[object, str], list[float | None]] = {}
        for g in own:
            small = [c for c in columns if sizes[(g, c)] <= budget]
            if small:
                found = _quantiles(rows.where(F.col(by) != F.lit(g)), small, list(probs), None, budget, accuracy, batch)
                result |= {(g, c): found[(None, c)] for c in small}
        large = [c for c in dict.fromkeys(columns) if any(sizes[(g, c)] > budget for g in own)]
        for start in range(0, len(large), batch):
            part = large[start:start + batch]
            asked = {(g, c): n for (g, c), n in sizes.items() if c in part and n > budget}
            found = _order_statistics(rows, by, part, {at: _ranks(probs, n) for at, n in asked.items()},
                                      budget, accuracy, outside=True)
            result |= {(g, c): _interpolated(found, g, c, probs, n) for (g, c), n in asked.items()}
        return result
    finally:
        rows.unpersist()


def _ranks(probs: Sequence[float], n: int) -> set[int]:
    return {r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}


def _interpolated(found: Mapping[tuple[object, str, int], float], group: object, c: str,
                  probs: Sequence[float], n: int) -> list[float]:
    values = []
    for p in probs:
        at = p * (n - 1)
        lo, hi = found[(group, c, math.floor(at))], found[(group, c, math.ceil(at))]
        values.append(lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)))
    return values


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              by: str | None = None, budget: int = 500_000, accuracy: int = 2_000,
              batch: int = 40, hold: bool = True) -> dict[tuple[object, str], list[float | None]]:
    """Exact linearly interpolated quantiles, keyed by ``(group, column)``.

    ``by`` is a class-like column with few values (a missing class is left out);
    without it the group is ``None``.  No aggregation ever holds more than
    ``budget`` values: columns that fit are answered by the built-in exact
    ``percentile``; of larger ones, ``batch`` at a time, one sketch a column gives
    edges, the rows between them are counted, and only buckets with a wanted rank
    are looked into.  The work does not grow with the number of quantiles.

    The table is read two to six times, so the wanted columns are held on the
    executors meanwhile; ``hold=False`` reads the source again instead.
    """
    rows = df.select(*([by] if by else []), *[number(c).alias(c) for c in columns])
    if by:
        rows = rows.where(F.col(by).isNotNull())
    if hold:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _quantiles(rows, list(columns), list(probs), by, budget, accuracy, batch)
    finally:
        if hold:
            rows.unpersist()


def _quantiles(rows: DataFrame, columns: list[str], probs: list[float], by: str | None,
               budget: int, accuracy: int, batch: int
               ) -> dict[tuple[object, str], list[float | None]]:
    keys = [by] if by else []
    sizes: dict[tuple[object, str], int] = {}
    for row in rows.groupBy(*keys).agg(*[F.count(c).alias(c) for c in columns]).collect():
        for c in columns:
            sizes[(row[by] if by else None, c)] = row[c]
    largest = {c: max((n for (_, k), n in sizes.items() if k == c), default=0) for c in columns}

    result: dict[tuple[object, str], list[float | None]] = {}
    for part in _fitting_batches([c for c in columns if largest[c] <= budget], largest, budget):
        found = rows.groupBy(*keys).agg(
            *[F.percentile(c, literal_array(probs)).alias(c) for c in part])
        for row in found.collect():
            for c in part:
                result[(row[by] if by else None, c)] = [
                    None if v is None else float(v) for v in row[c] or [None] * len(probs)]

    large = [c for c in dict.fromkeys(columns) if largest[c] > budget]
    for start in range(0, len(large), batch):
        part = large[start:start + batch]
        ranks = {(group, c): _ranks(probs, n) for (group, c), n in sizes.items() if c in part and n}
        found = _order_statistics(rows, by, part, ranks, budget, accuracy)
        for (group, c), n in sizes.items():
            if c in part:
                result[(group, c)] = _interpolated(found, group, c, probs, n) if n else [None] * len(probs)
    return result


def _fitting_batches(columns: list[str], rows: Mapping[str, int],
                     budget: int) -> list[list[str]]:
    """Group columns so that the values of one aggregation stay within the budget."""
    batches: list[list[str]] = []
    used = budget + 1
    for c in columns:
        if used + rows[c] > budget:
            batches.append([])
            used = 0
        batches[-1].append(c)
        used += rows[c]
    return batches
