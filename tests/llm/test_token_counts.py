import os
import random

import pytest

from outcomelab.llm import token_counts as t

RANKS = os.environ.get("TOKEN_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary file")
LETTERS = "ab c  d\n\n'sre'll12é ,.!\t x漢"


@pytest.fixture(scope="module")
def counter():
    return t.Counter(t.load_ranks(RANKS))


def text_of(rng, n):
    return "".join(rng.choice(LETTERS) for _ in range(n))


def test_edits_agree_with_counting_anew(counter):
    rng = random.Random(1)
    for k in range(3000):
        text = text_of(rng, rng.randrange(0, 900 if k % 20 == 0 else 40))
        edits = t.clean_edits([(a, a + rng.randrange(0, 6), text_of(rng, rng.randrange(0, 5)))
                               for a in (rng.randrange(0, len(text) + 1) for _ in range(rng.randrange(0, 6)))], len(text))
        tree = t.CountTree.of(text, counter)
        assert (tree.tokens, tree.chars) == (len(counter.encoding.encode_ordinary(text)), len(text))
        got, _ = tree.edit(text, edits, counter)
        for a, b, new in reversed(edits):
            text = text[:a] + new + text[b:]
        assert got == text
        assert [n for lengths, _ in tree.slots for n in lengths] == [len(p) for p in t._PATTERN.findall(text)]
        assert (tree.tokens, tree.chars) == (len(counter.encoding.encode_ordinary(text)), len(text))
        more, _ = tree.edit(text, [(0, 0, "x ")], counter)          # and edits of the edited tree
        assert tree.tokens == len(counter.encoding.encode_ordinary(more))


def test_only_the_region_is_encoded(counter):
    text = "word and other, " * 20_000
    tree = t.CountTree.of(text, counter)
    changed, encoded = tree.edit(text, [(7, 9, "X"), (200_000, 200_003, ""), (len(text), len(text), "end")], counter)
    assert encoded < 30 and tree.tokens == len(counter.encoding.encode_ordinary(changed))


def test_tables(spark, docs_of):
    texts = ["mail me: a.b@c.org or +1 (234) 567-8901 now", None, "", "no contact", "x@y.zz"]
    docs = docs_of(texts + [(9, texts[0]), (9, texts[0]), (None, "a b")], ["1 AS n_tokens", "2 AS edits"])
    got = {r["doc_id"]: tuple(r)[1:] for r in t.edited_counts(docs, RANKS, rule=t.contact_edits).collect()}
    counter = t.Counter(t.load_ranks(RANKS))
    n = lambda s: len(counter.encoding.encode_ordinary(s))
    assert got[0][1:3] == (n(texts[0]), 2) and got[0][5] == n("mail me: [mail] or [phone] now") and got[9] == got[0]
    assert got[1] == got[2] == (0, 0, 0, 0, 0, 0) and got[3][1] == got[3][5] == n("no contact") and got[3][3] == 0
    assert t.edited_counts(docs.limit(0), RANKS).count() == 0
    rows = spark.createDataFrame([(1, "abc def", [(3, 3, "x"), (2, 5, "over"), (90, 99, "!")]), (2, None, [(0, 0, "hi")]),
                                  (3, "abc", None)], "doc_id long, text string, e array<struct<start:int,end:int,text:string>>")
    got = {r["doc_id"]: r["n_tokens_after"] for r in t.edited_counts(rows, RANKS, edits="e").collect()}
    assert got == {1: n("aboveref!"), 2: n("hi"), 3: n("abc")}


def test_kept_trees(spark, counter):
    texts = ["one two three " * 90, None, "", "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    edits = spark.createDataFrame([(0, [(4, 7, "2")]), (1, [(0, 0, "new")]), (3, None)],
                                  "doc_id long, edits array<struct<start:int,end:int,text:string>>")
    trees = t.count_trees(docs, RANKS)
    n = lambda s: len(counter.encoding.encode_ordinary(s or ""))
    assert {r["doc_id"]: r["n_tokens"] for r in trees.collect()} == {k: n(x) for k, x in enumerate(texts)}
    once = t.update_trees(docs.join(trees, "doc_id").join(edits, "doc_id", "left"), RANKS)
    more = edits.where("doc_id = 0")
    twice = t.update_trees(once.join(more, "doc_id", "left"), RANKS)
    for r in [*once.collect(), *twice.collect()]:
        assert r["n_tokens"] == n(r["text"])
        assert t.CountTree.from_bytes(r["tree"]).to_bytes() == r["tree"]
        assert r["n_encoded"] < 12
    assert {r["doc_id"]: r["text"][:9] for r in twice.collect()} == {0: "one 2hree", 1: "new", 2: "", 3: "short"}


def test_contacts_are_found_in_linear_time_and_as_before():
    import random
    import time

    import regex
    plain = regex.compile(r"(?P<mail>[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})|(?P<phone>\+?\d[\d ().-]{6,}\d)")
    rng = random.Random(1)
    parts = ["a@b.com", "-x@c.org", "123456789", "x", "@", ".", "+1 (22) 333-44 55", " ", "b.c@d", "%", "é", "..", "7@y.zz"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert t.contact_edits(text) == [(*m.span(), f"[{m.lastgroup}]") for m in plain.finditer(text)]
    begin = time.time()
    assert t.contact_edits("ab" * 1_000_000) == [] and len(t.contact_edits("a" * 500_000 + "@b.com " + "c" * 500_000)) == 1
    assert time.time() - begin < 10
