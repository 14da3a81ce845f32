import random
import re

import numpy as np
import pytest

from outcomelab.llm import fm_index as f

from .conftest import prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, window=10):
    phrases = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            phrases.setdefault(tuple(w[k:k + window]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, found = words(t), set()
        hit = [False] * len(w)
        for p, owners in phrases.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit[k:k + len(p)] = [True] * len(p)
                    found |= owners
        out.append((d, len(w), tuple(k for k, h in enumerate(hit) if h), tuple(sorted(found))))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = f.contaminated_spans(docs, table, **kw).collect()
    return sorted(((r["doc_id"], r["n_words"], tuple(k for s in r["spans"] for k in range(s["first"], s["end"])),
                    tuple(r["items"])) for r in got), key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    items = [(k, prose(k, rng.randrange(10, 30), 60)) for k in range(12)]
    items += [(20, "short ITEM"), (21, "w1"), (22, None), (23, " ..."), (24, items[0][1]), (24, items[3][1]),
              (None, prose(90, 11)), (25, "a a a a a a a a a a a a")]
    docs = []
    for d in range(30):
        parts = [prose(50 + d, rng.randrange(0, 40), 60)]
        for _ in range(rng.randrange(0, 3)):
            w = (rng.choice(items)[1] or "x").upper().split()
            a = rng.randrange(0, len(w))
            parts += ["-".join(w[a:]), prose(rng.random(), 5, 60)]
        docs.append((d, " ".join(parts)))
    docs += [(40, None), (41, ""), (42, "short"), (43, "item short"), (44, "short, item!"), (45, docs[1][1]),
             (45, docs[1][1]), (None, items[0][1]), (46, "a " * 40), (47, prose(90, 11)), (48, "é" + items[1][1])]
    return docs, items


def test_matches_brute_force(spark, docs_of, case):
    docs, items = case
    assert run(spark, docs_of(docs), items) == brute(docs, items)


def test_phrase_blocks_give_the_same(spark, docs_of, case):
    docs, items = case
    assert run(spark, docs_of(docs), items, phrase_words=60) == brute(docs, items)


def test_many_shards(spark, docs_of, case, monkeypatch):
    docs, items = case
    monkeypatch.setattr(f, "SHARD_BYTES", 300)
    assert run(spark, docs_of(docs), items) == brute(docs, items)


def test_empty_tables_and_clashing_names(spark, docs_of, case):
    docs, items = case
    assert run(spark, docs_of([]), items) == []
    assert run(spark, docs_of(docs), []) == brute(docs, [])
    table = spark.createDataFrame(items, "item_id long, text string")
    got = f.contaminated_spans(docs_of(docs, ["1 AS spans", "2 AS item_id", "'q' AS items"]), table)
    assert got.where("spans_in = 1 AND items_in = 'q'").count() == len(docs)


def test_removed_spans_leave_no_phrase(spark, docs_of, case):
    docs, items = case
    items = [(i, t) for i, t in items if t != "w1"]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = f.contaminated_spans(docs_of(docs), table)
    out = {}
    for r in f.without_spans(found).collect():
        gone = {k for s in r["spans"] for k in range(s["first"], s["end"])}
        source = next(t for d, t in docs if d == r["doc_id"])
        assert words(r["text"]) == [w for k, w in enumerate(words(source)) if k not in gone]
        if not gone:
            assert r["text"] == source
        out[r["doc_id"]] = r["text"]
    assert out[40] is None


def test_index_finds_and_locates_everything():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 700):
        text = np.append(rng.integers(1, 4, n), 0)
        assert f.suffix_array(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())
        index = f.FMIndex(text, 2, sample=5)
        phrases = [rng.integers(1, 4, 3).tolist() for _ in range(20)]
        low, high = index.search(np.array(phrases), np.full(20, 3))
        for p, a, b in zip(phrases, low, high):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == [
                i for i in range(n - 2) if text[i:i + 3].tolist() == p]
