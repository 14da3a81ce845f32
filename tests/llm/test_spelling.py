"""Neighbours, forms and roots against all pairs; counts against a plain loop."""

import random
import re
import zlib
from collections import Counter

import pytest

from outcomelab.llm import catalog, spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def edits(word, alphabet):
    for k in range(len(word) + 1):
        for c in alphabet:
            yield word[:k] + c + word[k:]
            if k < len(word):
                yield word[:k] + c + word[k + 1:]
        if k < len(word):
            yield word[:k] + word[k + 1:]


def counted(docs, slip, least_length=6, least=5):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def grouped(counts, ratio=5):
    alphabet = sorted({c for w in counts for c in w})
    form, rows = {}, []
    for w, n in counts.items():
        near = {v for v in edits(w, alphabet) if v in counts and v != w}
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        rows.append((w, n, len(near)))
    out = set()
    for w, n, k in rows:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, k, counts.get(form[w])))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("seed", range(25))
def test_search_finds_every_pair_once(seed):
    rng = random.Random(seed)
    letters = "abé"[:rng.randrange(1, 4)]
    known = list({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 120))})
    asked = [*known, "zab", "abz", "bzzb", "a" * 10]
    index = spelling.Vocabulary(known)
    got = [(asked[a], index.words[b]) for back in (False, True) for a, b in zip(*index.near(asked, back))]
    assert sorted(got) == sorted((a, b) for a in asked for b in known if one_edit(a, b))


def test_states_in_step():
    """Extending in any order of directions gives the interval of the same pattern."""
    import numpy as np
    rng = random.Random(1)
    text = np.array([rng.randrange(1, 5) for _ in range(300)])
    index = spelling.BidirectionalIndex(text, 3)
    for _ in range(200):
        at = rng.randrange(1, 295)
        low = high = at
        state = index.everywhere(1)
        for _ in range(4):
            right = rng.random() < .5
            high, low = (high + 1, low) if right else (high, low - 1)
            if low < 0 or high > 300:
                break
            state = index.extend(state, text[[high - 1 if right else low]], right)
            part = text[low:high].tolist()
            assert state[2][0] == sum(text[k:k + len(part)].tolist() == part for k in range(300 - len(part) + 1))


def test_query_over_the_whole_table(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    counts = counted(rows, 199)
    assert len(counts) > 100
    assert result(catalog.op12_fm_spelling(spark, folder)) == grouped(counts)


@pytest.mark.parametrize("indexed,asking", [(1 << 15, 1 << 17), (8, 16), (40, 5)])
def test_buckets_cut_into_parts_give_the_same(spark, indexed, asking):
    rng = random.Random(7)
    base = ["interna" + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 5))) for _ in range(150)]
    counts = {w: rng.choice([5, 6, 30, 200, 1000]) for w in base}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(spelling.variant_groups(words, indexed=indexed, asking=asking)) == grouped(counts)


def test_long_chain_and_ties(spark):
    counts = {"aaaaaa" + "b" * k: 5 ** (k + 1) for k in range(9)}
    counts |= {"zzzzza": 50, "zzzzzb": 50, "zzzzzc": 5, "alonely": 7, "x" * 3000: 5, "x" * 2999 + "y": 40}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = result(spelling.variant_groups(words))
    assert got == grouped(counts)
    assert ("zzzzzc", "zzzzza", "zzzzza", 5, 2, 50) in got


def test_counts_with_nulls_empties_repeats_and_clashing_names(spark, docs_of):
    text = "Élan ÉCOLES écoles Writing writing WRITING×÷ a_writing1writing " * 3
    docs = [(1, text), (1, text), (2, None), (3, ""), (None, text), (None, None), (4, "plainword " * 3000)]
    got = spelling.word_counts(docs_of(docs, ["'x' AS word", "1 AS n"]), slip=2)
    assert {r["word"]: r["n"] for r in got.collect()} == counted(docs, 2)
    empty = spelling.word_counts(docs_of(docs).limit(0))
    assert empty.count() == 0 and result(spelling.variant_groups(empty)) == set()
