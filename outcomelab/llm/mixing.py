"""Mixing sources to target weights by subset-sum budget fitting.

1. Documents are counted by source and exact length in words; targets come from the
   source totals (one row per source).
2. For each source a plan says how many documents of each length to take: whole
   passes over the source first, then the same share of every length, then the
   lengths with the largest remainders, and for the last ``CELLS`` words a bounded
   knapsack (a document of each remaining length as often as there are some left)
   that hits the budget exactly when any choice does.
3. Documents are selected by a seeded hash inside each (source, length).  Their rank
   is found in two levels, by hash ranges and inside a range, so that one source and
   one length may hold any share of the rows.

A task sees the distinct lengths of a source, never its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import held
from .words import SPACES, chunks

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 17
#: Words of a budget that are left to the knapsack.
CELLS = 1 << 16
#: Documents of one source and length that are ranked together.
RANGE_ROWS = 512


def count_words(data: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each of the concatenated texts."""
    if not len(data):
        return np.zeros(len(base) - 1, np.int64)
    inside = ~SPACES[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = base[:-1][base[:-1] < len(data)]
    starts[first] = inside[first]
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(starts, out=total[1:])
    return np.diff(total[base])


def _sizes(columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [count_words(data, base) for _, _, data, base in chunks(batch.column(columns))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:columns], pa.array(np.concatenate(n) if n else [], pa.int64())],
                [*batch.schema.names[:columns], "size"])
    return run


def knapsack(lengths: list[int], counts: list[int], budget: int) -> dict[int, int]:
    """How many of each length give the largest sum that is not above ``budget``.

    Bounded subset sum on a bit set; counts are cut into powers of two.
    """
    reached, limit = 1, (1 << (budget + 1)) - 1
    origin = np.full(budget + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for length, count in zip(lengths, counts):
        step, left = 1, min(count, budget // length if length else 0)
        while left and not reached >> budget & 1:
            k = min(step, left)
            new = (reached << (k * length)) & limit & ~reached
            if new:
                bits = np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8)
                origin[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(items)
                items.append((length, k))
                reached |= new
            left -= k
            step *= 2
    at, take = reached.bit_length() - 1, {}
    while at:
        length, k = items[origin[at]]
        take[length] = take.get(length, 0) + k
        at -= length * k
    return take


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int, cells: int = CELLS) -> np.ndarray:
    """How many documents of each length to take, so that their words come to ``budget``."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0:
        return np.zeros_like(counts)
    share = counts * (budget / total)
    take = np.minimum(np.floor(share).astype(np.int64), counts)
    left = budget - int((take * lengths).sum())
    rng = np.random.Generator(np.random.PCG64(seed))
    by_rest = np.lexsort((rng.permutation(len(lengths)), -(share - take)))
    moved = True
    while left > cells and moved:
        moved = False
        for i in by_rest:
            if left <= cells:
                break
            if take[i] < counts[i] and lengths[i] <= left:
                take[i] += 1
                left -= int(lengths[i])
                moved = True
    order = [i for i in rng.permutation(len(lengths)) if lengths[i] <= left and take[i] < counts[i]]
    chosen = knapsack([int(lengths[i]) for i in order], [int(counts[i] - take[i]) for i in order],
                      min(left, cells))
    for i in order:
        take[i] += chosen.get(int(lengths[i]), 0)
    return take


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target`` to one row per source (``source, source_size``).

    ``share`` of all words is dealt by weight; a source stops at ``most`` times its
    size and the excess is dealt again.  In order of size per weight the full sources
    come first, so the level up to which all others rise follows from running sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    rows = totals.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]),
                                             F.pmod(place, F.lit(len(weights))).cast("int")))
    rows = rows.withColumn("most", F.lit(float(most)) * F.col("source_size"))
    rows = rows.withColumn("turn", F.col("most") / F.col("weight"))
    by_turn = Window.orderBy("turn", F.col("source").asc_nulls_last())
    before = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    after = by_turn.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    full = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = (share * F.sum("source_size").over(everything) - full) / F.sum("weight").over(after)
    rows = rows.withColumns({"at": F.row_number().over(by_turn), "level": level})
    found = F.min(F.when(F.col("level") <= F.col("turn"), F.struct("at", "level"))).over(everything)
    return rows.withColumn("found", found).select(
        "source", "source_size", F.when(
            F.col("found").isNull() | (F.col("at") < F.col("found.at")), F.col("most"))
        .otherwise(F.col("weight") * F.col("found.level")).alias("target"))


def _plan(seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        budget = int(round(rows["target"].iloc[0] - rows["passes"].iloc[0] * rows["source_size"].iloc[0]))
        rows = rows.sort_values("size")
        rows["take"] = fit(rows["size"].to_numpy(), rows["n"].to_numpy(), budget, seed)
        return rows[["source", "size", "n", "source_size", "target", "passes", "take"]]
    return run


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row.

    A null text has no words; a null source is a source of its own, after all others.
    Rows without words are taken no times.  Repeated rows are documents of their own:
    of equal ones any may be selected, which gives the same rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       F.col(text).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    sized = held(rows.mapInArrow(_sizes(2), f"{fields}, size long")
                 .withColumn("draw", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"))), "sizes")
    lengths = held(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(totals, weights, share, most).withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(F.lit(0)).cast("long"))
    targets = targets.withColumnRenamed("source", "named")
    both = lengths.join(targets, F.col("source").eqNullSafe(F.col("named"))).select(
        "source", "size", "n", "source_size", "target", "passes")
    kind = rows.schema["source"].dataType.simpleString()
    plan = held(both.groupBy("source").applyInPandas(
        _plan(seed), f"source {kind}, size long, n long, source_size long, target double, passes long, take long"),
        "plan").withColumnsRenamed({"source": "named", "size": "length"})
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("named")) & (F.col("size") == F.col("length")))
    joined = joined.drop("named", "length")
    whole = joined.where("take = 0 OR take = n").withColumn("chosen", (F.col("take") > 0).cast("long"))

    # Rank inside (source, size) by the draw: first the range, then the place in the range.
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    part = joined.where("take > 0 AND take < n").withColumn(
        "range", F.floor((F.shiftrightunsigned(F.col("draw"), 11) / F.lit(float(1 << 53))) * ranges))
    part = held(part, "drawn")
    inside = Window.partitionBy("source", "size").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    before = held(part.groupBy("source", "size", "range").agg(F.count(F.lit(1)).alias("m")).select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("range").alias("r"),
        F.coalesce(F.sum("m").over(inside), F.lit(0)).alias("before")),
        "ranges")
    place = Window.partitionBy("source", "size", "range").orderBy("draw", "doc_id")
    ranked = part.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
                       & (F.col("range") == F.col("r")))
    ranked = ranked.withColumn("chosen", (F.col("before") + F.row_number().over(place)
                                          <= F.col("take")).cast("long"))
    columns = ["doc_id", "source", "size", "source_size", "target"]
    copies = (F.col("passes") + F.col("chosen")) * (F.col("size") > 0).cast("long")
    done = whole.select(*columns, "passes", "chosen").union(ranked.select(*columns, "passes", "chosen"))
    return done.select(*columns, copies.alias("copies"), (copies * F.col("size")).alias("taken"))
