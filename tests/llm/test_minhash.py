import random
import re

import numpy as np
import pytest

import corpus_pipeline
from outcomelab.llm import minhash as m

from .conftest import prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else (
        frozenset([tuple(w)]) if w else frozenset())


def brute(rows, num, den):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in sets:
        for j, b in sets:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def near(text, edits, rng):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    rows = []
    for k in range(6):
        base = prose(k, 150)
        rows += [near(base, rng.randrange(0, 9), rng) for _ in range(12)]
    rows += [None, "", "  ", "one two", "ONE two", "one two three", rows[0], rows[0].upper(), prose(70, 5)]
    chain = prose(80, 120).split()      # a - b - c, linked in steps only
    rows += [" ".join(chain[k * 6:k * 6 + 90]) for k in range(5)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize(("num", "den"), [(85, 100), (8, 10), (6, 10)])
def test_matches_brute_force(docs_of, rows, num, den):
    got = m.document_components(docs_of(rows), num=num, den=den).collect()
    assert sorted(tuple(r)[:3] for r in got) == brute(rows, num, den)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_rest_of_buckets_in_many_blocks(docs_of, rows, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 3)
    got = m.document_components(docs_of(rows), num=85, den=100).collect()
    assert sorted(tuple(r)[:3] for r in got) == brute(rows, 85, 100)


def test_a_group_below_the_threshold_is_written_in_proportion(docs_of, monkeypatch):
    """Texts of similarity about 0.75 agree pair by pair on signatures; no list of pairs is written."""
    written = {}

    def counting(df, name, held=m.held):
        out = held(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(m, "held", counting)
    rng = random.Random(9)
    base = prose(60, 200)
    rows = [(k, near(base, 3, rng)) for k in range(120)]
    open_rows = []
    for n in (60, 120):
        written.clear()
        got = m.document_components(docs_of(rows[:n]), num=85, den=100).collect()
        assert sorted(tuple(r)[:3] for r in got) == brute(rows[:n], 85, 100)
        assert 0 < written["named"] <= 2 * m.BANDS * n and written["links"] <= 2 * m.BANDS * n
        open_rows.append(written["named"])
    assert open_rows[1] < 2.5 * open_rows[0]


def test_nulls_repeated_ids_and_clashing_names(docs_of):
    long = prose(1, 50)
    rows = [(3, long), (3, long), (None, long), (None, prose(2, 50)), (5, prose(3, 50)), (5, long), (7, None)]
    docs = docs_of(rows, ["1 AS node", "'x' AS set_key", "2 AS component", "3 AS __text1"])
    got = m.near_duplicates(docs)
    found = [tuple(r) for r in m.document_components(docs).collect()]
    assert sorted(found, key=str) == sorted([
        (3, 46, 3, True), (3, 46, 3, True), (None, 46, 3, False), (None, 46, None, True),
        (5, 46, 3, False), (5, 46, 3, False), (7, 0, 7, True)], key=str)
    kept = m.keep_one(docs, got).collect()
    assert kept[0].asDict().keys() == set(docs.columns)
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"] is not None) == [
        (3, long), (5, prose(3, 50)), (7, None)]
    assert [r["text"] for r in kept if r["doc_id"] is None] == [prose(2, 50)]


def brute_ids(rows, num, den):
    """Components of documents: rows with one id are one node."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            both = len(sets[i] & sets[j])
            if a == b or both and den * both >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (a, _) in enumerate(rows):
        least[find(i)] = min(a, least.get(find(i), a))
    return sorted((a, len(sets[i]), least[find(i)], a == least[find(i)]) for i, (a, _) in enumerate(rows))


@pytest.mark.parametrize("block", [512, 3])
def test_any_ids_and_one_id_on_several_texts(docs_of, monkeypatch, block):
    """Ids at and beyond 2**62 and below 0; an id on differing texts in buckets that stay open."""
    monkeypatch.setattr(m, "BLOCK", block)
    rng = random.Random(8)
    a, b, c = prose(1, 200), prose(2, 200), prose(3, 200)
    rows = [(5, a), (5, b), (7, near(a, 7, rng)), (1 << 62, c), ((1 << 63) - 1, near(c, 1, rng)), (-(1 << 63), near(c, 2, rng)),
            (-4, prose(4, 60)), (-4, prose(5, 60))]
    rows += [(100 + k, near(a, 3 + k % 9, rng)) for k in range(25)] + [(300 + k, near(b, 4 + k % 7, rng)) for k in range(25)]
    rows += [(100 + k, near(c, 5 + k, rng)) for k in range(6)]
    got = sorted(map(tuple, m.document_components(docs_of(rows), num=85, den=100).collect()))
    assert got == brute_ids(rows, 85, 100)


def test_unrelated_texts_with_one_id_all_stay(spark, docs_of):
    rng = random.Random(6)
    a, b, c, d = (prose(100 + k, 80) for k in range(4))
    rows = [(0, a), (0, b), (1, c), (1, near(a, 1, rng)), (2, near(b, 1, rng)), (2, d), (2, d), (3, near(c, 1, rng)),
            (None, near(d, 1, rng)), (None, prose(110, 80)), (4, None), (4, ""), (-7, c)]
    docs = docs_of(rows, ["1 AS node", "2 AS component", "3 AS id", "4 AS none"])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert kept.columns == docs.columns
    want = [(0, a), (0, b), (-7, c), (2, d), (None, prose(110, 80)), (4, None), (4, "")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_empty_table(docs_of):
    assert m.near_duplicates(docs_of([])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
        a, b = m.signature(np.unique(x[:500])), m.signature(np.unique(x[100:]))
        errors.append((a == b).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
