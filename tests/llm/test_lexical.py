"""Ranked search against scores of all pairs, computed plainly."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from outcomelab.llm import catalog, lexical

from .conftest import prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                score += w * (1000000000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * len(held) // total)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, docs_of, **kw):
    table = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical.top_documents(docs_of(docs), table, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    items = [(k, prose(k, rng.randrange(3, 25), 150)) for k in range(14)]
    items += [(20, "W1 w1, W2!"), (21, None), (22, "..."), (23, "nowhere"), (20, "W1 w1, W2!"), (24, items[2][1]),
              (25, "w3"), (25, "w4"), (None, "w5 w6")]
    docs = [(d, prose(100 + d, rng.randrange(1, 80), 300)) for d in range(150)]
    docs += [(200 + k, items[k % 14][1] + " " + prose(k, 5, 300)) for k in range(25)]
    docs += [(300, None), (301, ""), (302, "w1 " * 3000), (303, "-,-"), (304, items[0][1]), (305, items[0][1]),
             (None, items[0][1]), (5, items[0][1]), (5, items[0][1]), (-7, "É w1 é")]
    return docs, items


@pytest.mark.parametrize("block", [1 << 18, 60])
def test_same_as_all_pairs(spark, docs_of, case, block):
    docs, items = case
    assert run(spark, docs, items, docs_of, block_terms=block) == brute(docs, items)


def shard_of(rng, n, width):
    first, found = [0], []
    for _ in range(n):
        found += rng.sample(range(width), rng.randrange(1, 12))
        first.append(len(found))
    counts = np.array([rng.choice([1, 1, 1, 2, 5]) for _ in found], np.int64)
    return np.array([rng.randrange(5, 300) for _ in range(n)], np.int64), np.array(first), np.array(found, np.int64), counts


@pytest.mark.parametrize("seed", range(6))
def test_pruned_shards_lose_nothing(seed, monkeypatch):
    """Small buckets, many shards with one running best: equal to scoring every vector, with fewer scored."""
    monkeypatch.setattr(lexical, "BUCKET", 16)
    rng = random.Random(seed)
    weights = np.array([rng.choice([0, 50, 3000, 9000]) for _ in range(60)], np.int64)
    items = [np.array(rng.sample(range(60), rng.randrange(1, 9))) for _ in range(12)]
    ranking = lexical.Ranking(items, weights, 5000, 700_000, 3)
    best, plain, scored = lexical.Best(12, 3), [[] for _ in items], 0
    for s in range(5):
        n, first, found, counts = shard_of(rng, 200, 60)
        ids = [s * 200 + k for k in range(200)]
        scored += lexical.search_shard(ranking, best, ids, n, first, found, counts)
        impact = ranking.impacts(n, np.repeat(np.arange(200), np.diff(first)), counts)
        for d in range(200):
            row = dict(zip(found[first[d]:first[d + 1]].tolist(), impact[first[d]:first[d + 1]].tolist()))
            for q, x in enumerate(items):
                score = sum(int(weights[t]) * row.get(t, 0) for t in x.tolist())
                if score:
                    plain[q].append((-score, ids[d]))
    for q in range(12):
        assert [(r[0], r[3]) for r in best.found[q]] == sorted(plain[q])[:3]
    assert scored < sum(map(len, plain)) / 2


def test_query_over_the_whole_table(spark, folder):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{folder}/{t}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert sorted(map(tuple, catalog.op11_norm_buckets(spark, folder).collect()), key=str) == want


def test_empty_tables_and_clashing_names(spark, docs_of, case):
    docs, items = case
    assert run(spark, [], items, docs_of) == [] and run(spark, docs, [], docs_of) == []
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS rank", "2 AS score", "3 AS doc_id")
    found = lexical.top_documents(docs_of(docs, ["'x' AS item_id", "9 AS score", "0 AS n", "1 AS total"]), table)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)
