import random
import re
from collections import Counter

import numpy as np
import pytest

from outcomelab.llm import rlz_dedup as r

from .conftest import prose


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[k:k + window]) for w in texts for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def run(docs, **kw):
    parsed = r.parse(r.duplicate_windows(docs, **kw), kw.get("window", r.WINDOW))
    return sorted(map(tuple, r.remove_duplicates(docs, parsed).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    passages = [prose(k, 60) for k in range(4)]
    rows = []
    for i in range(40):
        parts = [prose(100 + i, rng.randrange(5, 90))]
        for _ in range(rng.randrange(0, 3)):
            words = rng.choice(passages).split()
            a = rng.randrange(0, 25)
            words = words[a:a + rng.randrange(20, 60)]
            if rng.random() < 0.4:
                words[rng.randrange(len(words))] = "other"
            parts += ["\n".join(words), prose(rng.random(), rng.randrange(1, 30))]
        rows.append((i, " ".join(parts)))
    rows += [(50, None), (51, ""), (52, " \t\n"), (53, "one two"), (54, rows[0][1]), (54, rows[0][1]),
             (None, rows[1][1]), (None, None), (55, "same " * 200), (56, prose(9, 35)), (57, prose(9, 35)),
             (58, prose(9, 34)), (59, "é漢 " * 40)]
    return rows


def test_matches_brute_force(docs_of, rows):
    assert run(docs_of(rows)) == brute(rows, 35)


def test_other_window_and_anchor(docs_of, rows):
    assert run(docs_of(rows), window=12, anchor=5) == brute(rows, 12)
    with pytest.raises(ValueError):
        r.duplicate_windows(docs_of(rows), window=5, anchor=6)


def test_copies_that_differ_from_the_first_but_not_from_each_other(docs_of):
    a = prose(1, 100).split()
    b = a[:50] + ["x"] + a[51:]
    rows = [(0, " ".join(a)), (1, " ".join(b)), (2, " ".join(b))]
    assert run(docs_of(rows)) == brute(rows, 35)


def test_empty_table_and_full_filter(docs_of, rows, monkeypatch):
    assert run(docs_of([])) == []
    monkeypatch.setattr(r, "MAX_FILTER_BITS", 1)       # everything passes: more work, same result
    assert run(docs_of(rows)) == brute(rows, 35)


def test_factors_point_to_equal_words(docs_of, rows):
    plain = [(i, t) for i, t in rows if i is not None and i < 50]
    docs = docs_of(plain)
    words = {i: t.split() for i, t in plain}
    found = r.factors(r.parse(r.duplicate_windows(docs))).collect()
    assert found
    ends = {}
    for f in sorted(found, key=lambda f: (f["doc_id"], f["start"])):
        assert f["start"] >= ends.get(f["doc_id"], 0)        # factors of a parse never overlap
        ends[f["doc_id"]] = f["start"] + f["length"]
    for f in found:
        assert f["length"] >= 35
        a, b = f["start"], f["ref_start"]
        assert words[f["doc_id"]][a:a + f["length"]] == words[f["ref_doc"]][b:b + f["length"]]


def test_factors_are_the_longest_from_left_to_right():
    rng = random.Random(5)
    for _ in range(400):
        window = rng.randrange(1, 6)
        matches = sorted((a, a + rng.randrange(window, 15)) for a in (rng.randrange(0, 40) for _ in range(rng.randrange(9))))
        expected, at = [], 0
        while at < 60:
            reach = max((b for a, b in matches if a <= at), default=0)
            if reach - at >= window:
                expected.append((at, reach))
                at = reach
            else:
                at += 1
        parsed = r.greedy(matches, window)
        assert [p[:2] for p in parsed] == expected
        assert all(matches[k][0] <= a and matches[k][1] == b for a, b, k in parsed)
        starts = {s for a, b in matches for s in range(a, b - window + 1)}
        inside = {s for a, b, _ in parsed for s in range(a, b - window + 1)}
        spans = r.boundary_windows([(a, b - window + 1) for a, b in matches], parsed, window)
        got = [s for a, b in spans for s in range(a, b - window + 1)]
        assert len(got) == len(set(got)) and set(got) == starts - inside


def test_matches_on_one_line_join():
    start, end = [0, 30, 66, 2], [35, 65, 101, 40]
    gap = np.array([5, 5, 5, 6])
    first, ends = r.longest_matches(np.zeros(4, int), [np.zeros(4, int)] * 3, gap, np.array(start), np.array(end))
    assert [(start[k], int(gap[k]), e) for k, e in zip(first, ends.tolist())] == [(0, 5, 65), (2, 6, 40), (66, 5, 101)]
