import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from outcomelab.llm.components import components
from outcomelab.llm.words import NOT_ALNUM, SPACES, chunks, split_words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXT = st.text(alphabet="aAbZ09é漢 \t\n\x0b\x1c.-\x00\x7f ", max_size=30)


def words_of(texts, separators, lower, limit):
    out, hashes = [], []
    for _, end, data, base in chunks(pa.array(texts, pa.string()), limit):
        w = split_words(data, base, separators, lower)
        raw = data.tobytes()
        all_words = [raw[a:b].decode() for a, b in zip(w.starts, w.ends)]
        out += [all_words[w.first[d]:w.first[d + 1]] for d in range(len(base) - 1)]
        hashes += w.hashes.tolist()
    return out, hashes


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.sampled_from([1, 20, 1 << 20]))
def test_words_are_those_of_the_patterns(texts, limit):
    got, _ = words_of(texts, SPACES, False, limit)
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    got, hashes = words_of(texts, NOT_ALNUM, True, limit)
    expected = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW)) for t in texts]
    assert [[w.translate(LOW) for w in d] for d in got] == expected
    flat = [w for d in expected for w in d]
    by_word = dict(zip(flat, hashes))
    assert [by_word[w] for w in flat] == hashes
    assert len(set(hashes)) == len(set(flat))


def test_windows_stay_inside_a_text():
    w = next(split_words(d, b, SPACES, False) for _, _, d, b in chunks(pa.array(["a b c", "a b", "a b c"])))
    start, hashes = w.windows(2)
    assert start.tolist() == [0, 1, 3, 5, 6]
    assert hashes[0] == hashes[2] == hashes[3] and hashes[1] == hashes[4] != hashes[0]


def test_components_match_union_find(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 150, (110, 2))] + [(k, k + 1) for k in range(200, 260)]
    pairs += [(300, k) for k in range(301, 340)] + [(300, 301)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame([*pairs, (7, 7)], "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in root}
    assert len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def thue_morse(n, x, y):
    """The word of x and y and its complement: alike under any polynomial hash modulo 2**64."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join((x, y)[b] for b in bits), "".join((y, x)[b] for b in bits)


def test_no_constructed_collisions():
    for n in (8, 256, 1024, 4096, 65536):
        one, other = thue_morse(n, "a", "b")
        _, hashes = words_of([f"{one} {other}", one], SPACES, False, 1 << 20)
        assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
        pairs = [thue_morse(n, "ab", "ba")[k] for k in (0, 1)]
        _, hashes = words_of(pairs, NOT_ALNUM, True, 1 << 20)
        assert hashes[0] != hashes[1]
        a, b = ([f"{w} " + " ".join(f"w{k}" for k in range(34))] for w in (one, other))
        sums = []
        for texts in (a, b):
            for _, _, data, base in chunks(pa.array(texts, pa.string())):
                sums.append(split_words(data, base, SPACES, False).windows(35)[1].tolist())
        assert len(sums[0]) == 1 and sums[0] != sums[1]


def test_hashes_depend_on_the_word_alone():
    rng = np.random.default_rng(1)
    known = {}
    for n in [*range(1, 40), 255, 256, 257, 300]:
        for _ in range(20):
            w = "".join(rng.choice(list("abcd"), n))
            known[w] = None
    words = list(known)
    _, first = words_of([" ".join(words)], SPACES, False, 1 << 20)
    _, again = words_of(["x" * k + " " + w for k, w in enumerate(reversed(words))], SPACES, False, 1 << 20)
    assert len(set(first)) == len(words)
    assert dict(zip(words, first)) == dict(zip(reversed(words), again[0:0] + [h for h in again if h in set(first)]))
