"""Ranked lexical search as an exact maximum-inner-product join, after LEMP.

A document is an *impact vector*: for each of its terms that some query uses, the term's
weight times its integer impact in the document.  A query is a vector of ones over its
terms, so their inner product is the score.  Documents are never shuffled: each task keeps
the best found so far and goes through its vectors in shards of bounded size,

* ordered by length (Euclidean norm) and cut into *buckets* of like lengths;
* by the Cauchy-Schwarz inequality a bucket whose longest vector cannot reach the worst
  of a query's best is left out for that query, and so are all shorter ones of the shard;
* inside a bucket the largest value of each coordinate bounds what coordinates not yet
  looked at can add: the rarest terms are added up until vectors without them are out,
  and what remains of a touched vector is bounded by its coordinates and its length;
* survivors are scored in 64-bit integers, which alone decide.

Bounds are floating-point with a margin and only ever leave out what cannot win.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import held
from .words import chunks

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Terms of the queries that are searched in one pass over the documents.
BLOCK_TERMS = 1 << 18
#: Coordinates of a shard, and vectors of a bucket.
SHARD, BUCKET = 1 << 20, 1024
MARGIN = 1 - 1e-9


def terms_of(data: np.ndarray) -> list[str]:
    """Terms of a UTF-8 text, only A-Z lower-cased."""
    return TERM.findall(data.tobytes().lower().decode())


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for low, high, data, base in chunks(column):
        for k in range(high - low):
            yield low + k, terms_of(data[base[k]:base[k + 1]])


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, terms`` of the distinct items that have terms."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, found in _texts(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array(
                    [sorted(set(found))], pa.list_(pa.string()))], ["item", "terms"])

    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).distinct()
    return rows.mapInArrow(run, f"item {kind}, terms array<string>").where("size(terms) > 0")


VECTOR = "n long, terms array<int>, counts array<long>, total boolean"


def _vectors(shared):
    """Term counts of each document in the vocabulary, and a row of totals for each task.

    In a row of totals ``n`` is the number of terms of all documents with any, the term
    -1 counts these documents and the others count those that hold them.
    """
    def batch_of(ids, n, first, terms, counts, total) -> pa.RecordBatch:
        lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x)) for x in (
            np.asarray(terms, np.int32), np.asarray(counts, np.int64))]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), *lists, pa.array([total] * len(n))], ["doc", "n", "terms", "counts", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: dict[str, int] = shared.value
        number = vocabulary.get
        holding = np.zeros(len(vocabulary), np.int64)
        documents, words, kind = 0, 0, None
        for batch in batches:
            kind = batch.column(0).type
            rows, n, first, terms, counts = [], [], [0], [], []

            def made() -> pa.RecordBatch:
                np.add.at(holding, np.array(terms, np.int64), 1)
                return batch_of(batch.column(0).take(pa.array(rows, pa.int64())), n, first, terms, counts, False)

            for k, found in _texts(batch.column(1)):
                if not found:
                    continue
                documents, words = documents + 1, words + len(found)
                mine = [(i, c) for t, c in Counter(found).items() if (i := number(t)) is not None]
                if not mine:
                    continue
                rows.append(k)
                n.append(len(found))
                terms += [i for i, _ in mine]
                counts += [c for _, c in mine]
                first.append(len(terms))
                if len(terms) > 1 << 18:
                    yield made()
                    rows, n, first, terms, counts = [], [], [0], [], []
            if rows:
                yield made()
        if documents:
            some = np.flatnonzero(holding)
            yield batch_of(pa.nulls(1, kind), [words], [0, len(some) + 1], np.append(some, -1),
                           np.append(holding[some], documents), True)
    return run


class Ranking:
    """What the tasks need to know of the queries and of the whole corpus."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, documents: int, words: int, k: int):
        self.weights, self.documents, self.words, self.k = weights, documents, words, k
        #: Terms of each item that add anything, the heaviest first.
        self.items = []
        for terms in items:
            terms = terms[weights[terms] > 0]
            self.items.append(terms[np.argsort(-weights[terms], kind="stable")])

    def impacts(self, n: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The integer impact of each count in its document of ``n`` terms."""
        m = 10 + 90 * n * self.documents // self.words
        return 1_000_000_000 * counts // (1000 * counts + 8 * m[owner])


class Best:
    """The best ``k`` documents of each item so far."""

    def __init__(self, n: int, k: int):
        self.k, self.found = k, [[] for _ in range(n)]
        self.least = np.zeros(n)        # what a document must reach; above 0 in any case

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        if len(scores) > self.k:
            ok = np.flatnonzero(scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k])
        else:
            ok = np.arange(len(scores))
        rows = [(-s, ids[j] is None, 0 if ids[j] is None else ids[j], ids[j])
                for j, s in zip(ok.tolist(), scores[ok].tolist()) if s > 0]
        if rows:
            self.found[item] = sorted(self.found[item] + rows, key=lambda r: r[:3])[:self.k]
            if len(self.found[item]) == self.k:
                self.least[item] = -self.found[item][-1][0]


def search_shard(ranking: Ranking, best: Best, ids: list, n: np.ndarray, first: np.ndarray,
                 terms: np.ndarray, counts: np.ndarray) -> int:
    """Bring ``best`` up to date with the vectors of a shard; returns how many were scored exactly."""
    owner = np.repeat(np.arange(len(n)), np.diff(first))
    whole = ranking.weights[terms] * ranking.impacts(n, owner, counts)
    value = whole.astype(float)
    length = np.sqrt(np.bincount(owner, value * value, len(n)))
    order = np.argsort(-length, kind="stable")
    place = np.empty(len(n), np.int64)
    place[order] = np.arange(len(n))
    row = place[owner]
    by = np.lexsort((terms, row // BUCKET))         # bucket, then coordinate
    row, terms, whole, value = row[by], terms[by], whole[by], value[by]
    edges = np.searchsorted(row // BUCKET, np.arange((len(n) - 1) // BUCKET + 2))
    wide = np.sqrt([len(x) for x in ranking.items])
    width, scored = len(ranking.weights), 0
    for b in range(len(edges) - 1):
        low, high = edges[b], edges[b + 1]
        lengths = length[order[b * BUCKET:(b + 1) * BUCKET]]
        alive = np.flatnonzero((wide * lengths[0] >= best.least * MARGIN) & (wide > 0))
        if not len(alive):
            break                                   # shorter buckets cannot do better
        column, begin = np.unique(terms[low:high], return_index=True)
        at = np.full(width, -1, np.int64)
        at[column] = np.arange(len(column))
        begin = np.append(begin + low, high)
        most = np.maximum.reduceat(value[low:high], begin[:-1] - low) if high > low else np.zeros(0)
        for item in alive.tolist():
            mine = at[ranking.items[item]]
            mine = mine[mine >= 0]
            if not len(mine):
                continue
            rest = np.append(np.cumsum(most[mine][::-1])[::-1], 0.0)
            least = best.least[item] * MARGIN
            if rest[0] < least:
                continue
            # The first coordinates, until a vector without any of them is out.
            focus = int(np.argmax(rest < least)) if rest[-1] < least else len(mine)
            sums, squares = np.zeros(len(lengths)), np.zeros(len(lengths))
            for c in mine[:focus].tolist():
                span = slice(begin[c], begin[c + 1])
                sums[row[span] - b * BUCKET] += value[span]
                squares[row[span] - b * BUCKET] += value[span] ** 2
            behind = np.sqrt(np.maximum(lengths * lengths * (1 + 1e-9) - squares, 0) * (len(mine) - focus))
            left = np.flatnonzero((sums > 0) & (sums + np.minimum(behind, rest[focus]) >= least))
            if not len(left):
                continue
            scored += len(left)
            mark = np.full(len(lengths), -1, np.int64)
            mark[left] = np.arange(len(left))
            exact = np.zeros(len(left), np.int64)
            for c in mine.tolist():
                span = slice(begin[c], begin[c + 1])
                to = mark[row[span] - b * BUCKET]
                exact[to[to >= 0]] += whole[span][to >= 0]
            rows = order[b * BUCKET + left]
            best.add(item, exact, [ids[r] for r in rows.tolist()])
    return scored


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking: Ranking = shared.value
        best, kind = Best(len(ranking.items), ranking.k), None
        for batch in batches:
            kind = batch.column(0).type
            first = batch.column(2).offsets.to_numpy().astype(np.int64)
            low = 0
            while low < len(batch):
                high = int(np.searchsorted(first, first[low] + SHARD, "right")) - 1
                high = min(max(high, low + 1), len(batch))
                part, edge = batch.slice(low, high - low), slice(first[low], first[high])
                search_shard(ranking, best, part.column(0).to_pylist(), part.column(1).to_numpy(),
                             first[low:high + 1] - first[low], batch.column(2).values.to_numpy()[edge].astype(np.int64),
                             batch.column(3).values.to_numpy()[edge])
                low = high
        for item, rows in enumerate(best.found):
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(rows), pa.int32()), pa.array([r[3] for r in rows], kind),
                     pa.array([-r[0] for r in rows], pa.int64())], ["number", "doc", "score"])
    return run


def _block(docs: DataFrame, block: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = block.collect()                  # at most about BLOCK_TERMS terms
    vocabulary = {t: i for i, t in enumerate(sorted({t for r in rows for t in r["terms"]}))}
    kind = docs.schema["doc"].dataType.simpleString()
    vectors = held(docs.mapInArrow(_vectors(spark.sparkContext.broadcast(vocabulary)), f"doc {kind}, {VECTOR}"),
                   "impact-vectors")
    totals = vectors.where("total")
    words = totals.agg(F.sum("n")).first()[0] or 0
    counted = {r["t"]: r["c"] for r in totals.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
               .groupBy(F.col("x.terms").alias("t")).agg(F.sum("x.counts").alias("c")).collect()}
    documents = counted.pop(-1, 0)
    weights = np.zeros(len(vocabulary), np.int64)
    for t, df in counted.items():
        weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    ranking = Ranking([np.array([vocabulary[t] for t in r["terms"]], np.int64) for r in rows],
                      weights, documents, words, k)
    found = vectors.where("NOT total").select("doc", "n", "terms", "counts").mapInArrow(
        _search(spark.sparkContext.broadcast(ranking)), f"number int, doc {kind}, score long")
    names = spark.createDataFrame(
        [(i, r["item"]) for i, r in enumerate(rows)],
        T.StructType([T.StructField("number", T.IntegerType()), block.schema["item"]]))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(names, "number").select("item", "rank", "doc", "score"))


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each item, scores above 0.

    Every row of ``docs`` is a document.  Terms, weights and impacts are integers (see
    ``Ranking``) over all documents with a term.  Equal scores go by ascending id, null ids
    last.  Null and empty texts have no terms: such documents are never found and such items
    find nothing.  Repeated rows of an item count once; one id with several texts ranks for
    each of them.  Items of any number are searched in blocks of about ``block_terms`` terms
    (one item is never cut), a pass over the documents each.  Other columns are not looked
    at.  An empty table gives an empty result.
    """
    asked = held(query_terms(items, item_id, item_text), "query-terms")
    n = 1 + int(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms
    rows = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    found = None
    for b in range(n):
        part = _block(rows, asked.where(F.pmod(F.xxhash64("item", "terms"), F.lit(n)) == b), k)
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(id), "score")
