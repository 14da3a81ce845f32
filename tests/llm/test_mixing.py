import random

import numpy as np
import pytest

from outcomelab.llm import mixing as m

from .conftest import prose


def targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: weights[k % 3] for k, n in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [n for n in names if n not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[n] for n in rest)
        over = [n for n in rest if left * weight[n] / w > 2 * sizes[n]]
        if not over:
            return fixed | {n: left * weight[n] / w for n in rest}
        fixed |= {n: 2.0 * sizes[n] for n in over}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    sources = ["b", "a", "é", None, "Z", "c", "d"]
    rows = [(k, prose(k, rng.randrange(0, 60)), sources[min(6, int(rng.expovariate(0.7)))]) for k in range(400)]
    return rows + [(500, None, "a"), (501, "", "zero"), (None, "x y", "b"), (7, "q r s", "b"), (7, "q r s", "b")] + [
        (600 + k, "w " * 30, "hot") for k in range(700)]


def test_targets_and_taken_words(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS n")
    got = m.mix_sources(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]}
        assert all(abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= (30 if s == "hot" else 1)
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in got)
    again = m.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r["taken"] for r in m.mix_sources(docs).collect()] == [0, 0]
    assert m.mix_sources(docs.limit(0)).count() == 0


def test_knapsack_is_best():
    rng = random.Random(3)
    for _ in range(200):
        lengths = rng.sample(range(1, 30), rng.randrange(1, 6))
        counts = [rng.randrange(1, 4) for _ in lengths]
        budget = rng.randrange(0, 80)
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        take = m.knapsack(lengths, counts, budget)
        assert sum(n * k for n, k in take.items()) == max(s for s in sums if s <= budget)
        assert all(k <= counts[lengths.index(n)] for n, k in take.items())


def test_fit_hits_large_budgets():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(1, 5000, 800))
    counts = rng.integers(1, 400, len(lengths))
    total = int((lengths * counts).sum())
    for share in (0.001, 0.3, 0.97):
        take = m.fit(lengths, counts, int(total * share), 1)
        assert (take * lengths).sum() == int(total * share) and (take <= counts).all() and (take >= 0).all()
    assert m.fit(lengths, counts, total + 5, 1).tolist() == counts.tolist()
