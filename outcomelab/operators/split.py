"""Exact stratified splits and folds without sorting or moving the table.

Rows are ordered inside each class by a salted hash of their id.  The few hash
values where one part ends and the next begins are found by counting hash
prefixes, three hex digits at a time; after that every row decides for itself by
comparing its own hash with those cuts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEX_PER_PASS = 3
HASH_LENGTH = 32
AFTER_ALL = "g"        # sorts after every hex digit


def row_hash(id_column: str, seed: int) -> Column:
    """Salted hash of an id; all missing ids count as one id, the empty text."""
    return F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(f"|{seed}")))


def allot(total: int, counts: Sequence[int]) -> list[int]:
    """Share ``total`` in proportion to ``counts``: floors, then largest remainders.

    Equal remainders go to the earlier class.
    """
    n = sum(counts)
    if not n:
        return [0] * len(counts)
    whole = [total * c // n for c in counts]
    order = sorted(range(len(counts)), key=lambda i: (-(total * counts[i] % n), i))
    for i in order[:total - sum(whole)]:
        whole[i] += 1
    return whole


def split_sizes(counts: Sequence[int], test_size: float,
                val_size: float | None = None) -> list[tuple[int, ...]]:
    """Per class: rows for test, and for validation when asked.

    The held-out totals are rounded up and the validation share is taken from what
    the test part leaves; what remains is shared over the classes.
    """
    n = sum(counts)
    left = allot(n - math.ceil(test_size * n), counts)
    test = [c - k for c, k in zip(counts, left)]
    if val_size is None:
        return [(t,) for t in test]
    m = sum(left)
    train = allot(m - math.ceil(val_size / (1 - test_size) * m), left)
    return [(t, k - r) for t, k, r in zip(test, left, train)]


def _prefix_counts(hashed: DataFrame, size: int) -> dict[object, list[tuple[str, int]]]:
    """Rows per class and hash prefix, in prefix order."""
    out: dict[object, list[tuple[str, int]]] = {}
    for row in (hashed.groupBy("y", F.substring("h", 1, size).alias("p"))
                .agg(F.count(F.lit(1)).alias("n")).collect()):
        out.setdefault(row["y"], []).append((row["p"], row["n"]))
    return {y: sorted(out[y]) for y in sorted(out)}


def hash_cuts(hashed: DataFrame, first: dict[object, list[tuple[str, int]]],
              ranks: dict[object, list[int]]) -> dict[object, list[str]]:
    """For each class and rank ``r``: a bound such that exactly ``r`` hashes lie below it.

    ``first`` holds the counts of the shortest prefixes; each further pass looks
    only at rows under the prefixes that a cut runs through, and brings back at
    most cuts x 4096 counts.  Rows with one and the same id share a hash and
    stay on one side of a cut.
    """
    bounds: dict[tuple[object, int], str] = {}
    open_cuts = {(y, r): ("", r) for y, wanted in ranks.items() for r in wanted}
    counts, size = first, HEX_PER_PASS
    while True:
        still_open = {}
        for (y, r), (prefix, need) in open_cuts.items():
            bound: str | None = prefix + AFTER_ALL
            for p, n in counts[y]:
                if not p.startswith(prefix):
                    continue
                if need == 0:
                    bound = p
                    break
                if need < n and size < HASH_LENGTH:
                    still_open[(y, r)], bound = (p, need), None
                    break
                need -= min(need, n)
                if need == 0:
                    bound = p + AFTER_ALL
                    break
            if bound is not None:
                bounds[(y, r)] = bound
        if not still_open:
            return {y: [bounds[(y, r)] for r in wanted] for y, wanted in ranks.items()}
        open_cuts, size = still_open, min(size + HEX_PER_PASS, HASH_LENGTH)
        within = F.lit(False)
        for y, p in sorted({(y, p) for (y, _), (p, _) in open_cuts.items()}, key=str):
            within = within | ((F.col("y") == F.lit(y)) & F.col("h").startswith(p))
        counts = _prefix_counts(hashed.where(within), size)


def assign_parts(df: DataFrame, label: str, id_column: str, seed: int,
                 ranks_of: Callable[[dict[object, int]], dict[object, list[int]]],
                 names: Sequence[object], out: str) -> DataFrame:
    """Append the part each row falls in; purely row-local once the cuts are known.

    ``ranks_of`` turns the class sizes into the ranks where the parts end.
    """
    h = row_hash(id_column, seed)
    hashed = df.where(F.col(label).isNotNull()).select(F.col(label).alias("y"), h.alias("h"))
    first = _prefix_counts(hashed, HEX_PER_PASS)
    ranks = ranks_of({y: sum(n for _, n in steps) for y, steps in first.items()})
    part = F.lit(None).cast("string" if isinstance(names[0], str) else "int")
    for y, bounds in hash_cuts(hashed, first, ranks).items():
        ladder = F.lit(names[-1])
        for name, bound in reversed(list(zip(names, bounds))):
            ladder = F.when(h < F.lit(bound), F.lit(name)).otherwise(ladder)
        part = F.when(F.col(label) == F.lit(y), ladder).otherwise(part)
    return df.withColumn(out, part)


def stratified_split(df: DataFrame, label: str, id_column: str, test_size: float = 0.2,
                     val_size: float | None = None, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Append ``test`` / ``val`` / ``train`` with exact per-class counts.

    Without ``val_size`` the table is cut in two.  Rows without a label get no part.
    """
    def ranks_of(counts: dict[object, int]) -> dict[object, list[int]]:
        sizes = split_sizes(list(counts.values()), test_size, val_size)
        return {y: list(accumulate(s)) for y, s in zip(counts, sizes)}

    names = ["test", "train"] if val_size is None else ["test", "val", "train"]
    return assign_parts(df, label, id_column, seed, ranks_of, names, out)


def stratified_folds(df: DataFrame, label: str, id_column: str, folds: int = 5,
                     seed: int = 42, out: str = "fold") -> DataFrame:
    """Append a 0-based fold; fold sizes differ by at most one row per class."""
    def ranks_of(counts: dict[object, int]) -> dict[object, list[int]]:
        return {y: [n * (k + 1) // folds for k in range(folds - 1)] for y, n in counts.items()}

    return assign_parts(df, label, id_column, seed, ranks_of, list(range(folds)), out)


def split_report(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """``(split, n, share, rate)`` for every part."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))
            .select(split, "n", F.try_divide(F.col("n"), total).alias("share"), "rate"))
