import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from outcomelab.llm import catalog
from outcomelab.llm import toxicity as t

BAD = ["stupid", "horrible", "pathetic", "disgusting"]


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdefgiklmnoprstu") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    texts, labels = [], []
    for k in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(20, 400))]
        if k % 4 == 0:
            for b in rng.sample(BAD, 3):
                w.insert(rng.randrange(len(w)), b)
        texts.append(" ".join(w))
        labels.append(int(k % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return t.train(*corpus(400, 1))


def test_held_out_accuracy(model):
    texts, labels = corpus(200, 2)
    p = model.scores(pa.array(texts)) >= t.THRESHOLD
    y = np.array(labels, bool)
    assert p[y].mean() > 0.9 and p[~y].mean() < 0.03


def test_misspellings_score_like_the_word(model):
    clean = corpus(8, 3)[0][1]
    scores = model.scores(pa.array([clean, clean + " stupid pathetic disgusting", clean + " stuupid pathetiic disgustingg"]))
    assert scores[0] < t.THRESHOLD <= scores[1] and scores[2] > scores[0] + 0.1


def test_scores_equal_slow_rescoring(model):
    """Word by word: parts from the word alone, runs and means in plain Python."""
    texts = [*corpus(12, 11)[0], *(" ".join(corpus(4, k)[0]) for k in (12, 13)), "Stupid stupid, STUPID", "x " * 600]

    def value(word):
        data = np.frombuffer(word.encode(), np.uint8)
        _, _, buckets = t.word_parts(t.split_words(data, np.array([0, len(data)]), t.NOT_ALNUM, True))
        return sum(float(model.table[b]) for b in buckets) / len(buckets)

    want = []
    for text in texts:
        words = re.findall(r"[a-z]+", text.lower())
        runs = -(-len(words) // t.RUN)
        cuts = [k * len(words) // runs for k in range(runs + 1)]
        odds = []
        for low, high in zip(cuts, cuts[1:]):
            distinct = set(words[low:high])
            odds.append(model.bias + t.STRETCH * sum(map(value, distinct)) / (len(distinct) + t.PAD))
        want.append(1 / (1 + math.exp(-max(odds))))
    assert max(len(text.split()) for text in texts) > 2 * t.RUN
    assert model.scores(pa.array(texts)) == pytest.approx(want, abs=1e-5)


def test_edge_texts(model):
    long = " ".join(corpus(1, 5)[0] * 300)
    scores = model.scores(pa.array([None, "", " . ", "x", "漢字 é", long, "line again\n" * 5000]))
    assert len(scores) == 7 and np.isfinite(scores).all() and ((scores >= 0) & (scores <= 1)).all()
    assert scores[0] == scores[1] == scores[2]
    assert scores[6] < t.THRESHOLD
    one = model.scores(pa.array(["a b stupid"]))
    assert model.scores(pa.array(["a b stupid"] * 3)).tolist() == one.tolist() * 3


def test_training_without_two_labels():
    assert t.train([], []).scores(pa.array(["a"]))[0] == 0.5
    assert t.train(["a b"], [1]).scores(pa.array(["a"]))[0] > 0.99
    assert t.train(["a b", None], [0, 0]).scores(pa.array(["a"]))[0] < 0.01


def test_fit_and_score_tables(spark, docs_of, monkeypatch):
    monkeypatch.setattr(t, "STEPS", 60)
    texts, y = corpus(120, 7)
    rows = list(enumerate(texts)) + [(None, texts[0]), (300, None), (301, ""), (0, texts[0])]
    docs = docs_of(rows, ["1 AS score", "2 AS id", "3 AS y", "4 AS draw"])
    labels = spark.createDataFrame([*enumerate(y), (0, 1), (None, 1), (5, None), (999, 1)], "doc_id long, toxic int")
    a, b = t.fit(docs, labels), t.fit(docs.repartition(5), labels)
    assert np.array_equal(a.table, b.table) and a.bias == b.bias        # reruns agree
    out = t.score(docs, a)
    assert out.columns[-1] == "score" and out.where("score_in = 1").count() == len(rows)
    empty = t.fit(docs.limit(0), labels)
    assert t.score(docs.limit(0), empty).count() == 0


def test_long_texts_and_copies_take_no_places_of_the_sample(spark, docs_of, monkeypatch):
    monkeypatch.setattr(t, "TRAIN_TOXIC", 10)
    monkeypatch.setattr(t, "TRAIN_CLEAN", 30)
    texts, y = corpus(120, 9)
    rows, marks = list(enumerate(texts)), list(enumerate(y))
    want = t.fit(docs_of(rows), spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert len(set(want.scores(pa.array(texts)))) > 2
    long = [(k, f"{texts[0]} " * 200) for k in range(500, 620)]
    assert min(len(x) for _, x in long) > t.TRAIN_CHARS
    marks += [(k, k % 2) for k, _ in long] + [(k, k % 2) for k in range(700, 820)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    rows += [(k, None) for k in range(700, 820)] + long
    got = t.fit(docs_of(rows + rows[:120] * 3), labels)
    assert np.array_equal(got.table, want.table) and got.bias == want.bias


def test_query_learns_from_other_rows_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(t, "STEPS", 60)
    texts, y = corpus(90, 8)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wrong = [(k, 1 - v if zlib.crc32(str(k).encode()) % 3 == 1 else v) for k, v in enumerate(y)]
    results = []
    for name, rows in (("a", list(enumerate(y))), ("b", wrong)):
        spark.read.parquet(f"{tmp_path}/documents.parquet").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(rows, "doc_id long, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        results.append(sorted(map(tuple, catalog.op7_subword_toxicity(spark, f"{tmp_path}/{name}").collect())))
    assert results[0] == results[1] and len(results[0]) == 90
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in results[0])
