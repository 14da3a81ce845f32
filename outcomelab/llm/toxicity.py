"""Toxicity by subword bags: embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with word ends marked) and itself; each
part is hashed to one of ``BUCKETS`` vectors.  A word's vector is the mean of its
parts; a text is cut evenly into runs of at most ``RUN`` words, a run's vector is the
mean of its distinct words (and of ``PAD`` empty ones), and two linear outputs go
through a softmax.  A text scores as its highest run, in training too: a few words in a
long text must not vanish in the mean, one word of a short text must not decide it, nor
a repeated line.  Vectors and outputs are trained jointly in numpy, so a misspelling
that was never seen still shares most of its parts with the word it is meant to be.

The training sample is bounded (``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` texts of at most
``TRAIN_CHARS`` characters, one an id, drawn by a hash of the id).  Because everything after the
embedding is linear, a trained model is one number per bucket; this table of fixed size
is what is broadcast, and every whole text is scored in the executors, whatever its
length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_ALNUM, Words, chunks, mix, prefix_hash, split_words, span_hash, _LOWER_VALUES

GRAMS = (3, 4, 5)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
#: The texts' means are stretched by this before the softmax: one word of a thousand must count.
STRETCH = 200.0
RUN, PAD = 256, 16
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 4500
TRAIN_CHARS = 40_000
#: Bytes of the sample that are cut into parts together.
TRAIN_CHUNK = 1 << 18
#: Parts that stand in a smaller share of the training texts, or in one only, have no
#: vector: they would only learn single texts.
LEAST_SHARE = 0.001
#: Training is so many batches, whatever the size of the sample.
STEPS, BATCH, RATE, SHRINK, SEED = 470, 64, 0.03, 0.025, 5
#: Fewer batches are never made, however ``STEPS`` is set.
LEAST_STEPS = 1
THRESHOLD = 0.7


def word_parts(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(number of each word among the distinct ones, offsets, buckets)``.

    ``buckets[offsets[u]:offsets[u + 1]]`` are the parts of distinct word ``u``.
    """
    distinct, example, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    starts, ends = words.starts[example], words.ends[example]
    prefix = prefix_hash(_LOWER_VALUES[words.data])
    whole = span_hash(prefix, starts, ends)
    begins = np.flatnonzero((words.data & 0xC0) != 0x80)        # characters
    begins = np.append(begins, len(words.data))
    low, high = np.searchsorted(begins, starts), np.searchsorted(begins, ends)
    owner, key = [np.arange(len(distinct))], [mix(whole, 90)]
    for n in GRAMS:
        counts = np.maximum(high - low - n + 1, 0)
        at = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        owner.append(np.repeat(np.arange(len(distinct)), counts))
        key.append(mix(span_hash(prefix, begins[at], begins[at + n]), n))
        # The first and the last n - 1 characters with the mark of the word's end.
        long = np.flatnonzero(high - low >= n - 1)
        owner += [long, long]
        key += [mix(span_hash(prefix, starts[long], begins[low[long] + n - 1]), 30 + n),
                mix(span_hash(prefix, begins[high[long] - n + 1], ends[long]), 60 + n)]
    owner, key = np.concatenate(owner), np.concatenate(key)
    by = np.argsort(owner, kind="stable")
    offsets = np.searchsorted(owner[by], np.arange(len(distinct) + 1))
    return number, offsets, (key[by] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def run_bounds(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each run (and the end), and the text that each run belongs to."""
    n = np.diff(first)
    count = -(-n // RUN)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return np.append(first[text] + k * n[text] // count[text], first[-1]), text


def bags(column: pa.Array) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """For each text: buckets and their shares of the mean, run by run."""
    for row, end, data, base in chunks(column, TRAIN_CHUNK):
        words = split_words(data, base, NOT_ALNUM, True)
        number, offsets, buckets = word_parts(words)
        bounds, text = run_bounds(words.first)
        runs: list[list] = [[] for _ in range(end - row)]
        for r, d in enumerate(text):
            mine = np.unique(number[bounds[r]:bounds[r + 1]])
            sizes = offsets[mine + 1] - offsets[mine]
            at = np.repeat(offsets[mine] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            share = np.repeat(1 / (len(mine) + PAD) / sizes, sizes)
            found, place = np.unique(buckets[at], return_inverse=True)
            runs[d].append((found, np.bincount(place, share, len(found)).astype(np.float32)))
        yield from (r or [(np.zeros(0, np.int64), np.zeros(0, np.float32))] for r in runs)


@dataclass
class Model:
    """``bias + STRETCH * mean over distinct words of the mean of table[parts]`` is a run's log odds."""

    table: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for _, _, data, base in chunks(column):
            words = split_words(data, base, NOT_ALNUM, True)
            odds = np.full(len(base) - 1, -np.inf)
            if len(words.hashes):
                number, offsets, buckets = word_parts(words)
                value = np.add.reduceat(self.table[buckets], offsets[:-1]) / np.diff(offsets)
                bounds, text = run_bounds(words.first)
                run = np.repeat(np.arange(len(text)), np.diff(bounds))
                run, number = np.divmod(np.unique(run * len(value) + number), len(value))
                total = np.bincount(run, value[number], len(text))
                n = np.bincount(run, minlength=len(text))
                np.maximum.at(odds, text, self.bias + STRETCH * total / (n + PAD))
            odds[np.isinf(odds)] = self.bias
            out.append(1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        return np.concatenate(out)


def train(texts: list[str | None], labels: list[int], steps: int | None = None, seed: int = SEED) -> Model:
    """Vectors and outputs together, by Adam on batches; both labels weigh the same in total."""
    rng = np.random.Generator(np.random.PCG64(seed))
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), 0.0 if not len(y) else (50.0 if y[0] else -50.0))
    column = pa.array(texts, pa.string())
    # Twice over the texts: what is kept of them are the parts that have a vector.
    texts_with = np.zeros(BUCKETS, np.int32)
    for runs in bags(column):
        texts_with[np.unique(np.concatenate([found for found, _ in runs]))] += 1
    known = texts_with >= max(2, LEAST_SHARE * len(y))
    place = np.cumsum(known, dtype=np.int32) - 1
    x = [[(place[found[known[found]]], share[known[found]]) for found, share in runs] for runs in bags(column)]
    width = int(known.sum())
    weight = (len(y) / (2 * np.bincount(y, minlength=2)))[y]
    vectors = rng.normal(0, 0.01, (width, DIMENSIONS)).astype(np.float32)
    outputs = rng.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    values = [vectors, outputs, bias]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    dense = np.zeros((BATCH, width), np.float32)
    step, steps = 0, max(STEPS, LEAST_STEPS) if steps is None else steps
    while step < steps:
        order = rng.permutation(len(y))
        table = vectors @ (outputs[:, 1] - outputs[:, 0])
        for at in range(0, len(order), BATCH)[:steps - step]:
            rows = order[at:at + BATCH]
            dense[:] = 0
            for r, d in enumerate(rows):
                found, share = max(x[d], key=lambda run: run[1] @ table[run[0]])
                dense[r, found] = share * STRETCH
            batch = dense[:len(rows)]
            hidden = batch @ vectors
            z = hidden @ outputs + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            g = (p * weight[rows, None] / len(rows)).astype(np.float32)
            grads = [batch.T @ (g @ outputs.T), hidden.T @ g, g.sum(axis=0)]
            rate = RATE * (1 - step / steps)
            step += 1
            for v, m, s, grad in zip(values, first, second, grads):
                m += 0.1 * (grad - m)
                s += 0.01 * (grad * grad - s)
                v -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
            # Vectors shrink towards zero, short ones all the way: few parts carry the label.
            norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)) + 1e-12
            vectors *= np.maximum(0, 1 - SHRINK * rate / RATE / norm)
    side = outputs[:, 1] - outputs[:, 0]
    table = np.zeros(BUCKETS, np.float32)
    table[known] = vectors @ side
    return Model(table, float(bias[1] - bias[0]))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bounded sample, all of it in one task, to one row with the model."""
    texts, labels = [], []
    for batch in batches:
        texts += batch.column(0).to_pylist()
        labels += batch.column(1).to_pylist()
    model = train(texts, labels)
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.table.tobytes()]), pa.array([model.bias])], ["table", "bias"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", label_id: str = "doc_id") -> Model:
    """Train on a bounded sample of the labelled rows of ``docs``.

    Null ids and null labels are left out; an id labelled twice counts as toxic if any
    label says so; null texts and texts longer than ``TRAIN_CHARS`` are not drawn (they are
    scored), and an id is drawn once, with one of its texts, however many rows it has.
    Without labels every score is one half, with one kind of label it is that label.
    """
    y = labels.where(F.col(label_id).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(label_id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(
        F.length("text") <= TRAIN_CHARS).withColumn("hash", F.xxhash64("text"))
    # Only what can be learned from is drawn.
    usable = texts.select("id", "hash").join(y, "id").groupBy("id", "y").agg(F.min("hash").alias("hash"))
    usable = usable.withColumn("draw", F.xxhash64(F.lit(SEED), "id"))
    ids = None
    for value, n in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        some = usable.where(F.col("y") == value).orderBy("draw", "id").limit(n)
        ids = some if ids is None else ids.union(some)
    # At most TRAIN_TOXIC + TRAIN_CLEAN rows of four numbers.
    drawn = texts.join(F.broadcast(ids), ["id", "hash"]).groupBy("draw", "id", "y").agg(F.min("text").alias("text"))
    sample = drawn.orderBy("draw", "id").limit(TRAIN_TOXIC + TRAIN_CLEAN).select("text", "y")
    model = sample.mapInArrow(_train, "table binary, bias double").first()
    if model is None:
        return train([], [])
    return Model(np.frombuffer(bytes(model["table"]), np.float32), model["bias"])


def _score(shared, columns: int, keep_text: bool):
    """Appends the score to rows whose last column is the text."""
    kept = columns if keep_text else columns - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.scores(batch.column(columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(score)], [*batch.schema.names[:kept], "__score"])
    return run


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score",
          keep_text: bool = True) -> DataFrame:
    """``docs`` with the probability of toxicity appended.

    Null and empty texts have no words and get what the model gives no evidence.  A
    column of ``docs`` with the name ``out`` is kept with ``_in`` added.
    """
    own = [F.col(f"`{c}`").alias(f"{c}_in" if c == out else c) for c in docs.columns if c != text]
    last = docs.select(*own, F.col(f"`{text}`").alias(f"{text}_in" if text == out else text))
    kept = last.schema.fields if keep_text else last.schema.fields[:-1]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "__score double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)      # BUCKETS numbers of four bytes
    return last.mapInArrow(_score(shared, len(last.columns), keep_text), schema).withColumnRenamed("__score", out)
