"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Index: each vector is scaled to length one, the common centre is taken off, the rest is
turned by a random rotation (into ``STRETCH`` times as many dimensions) and only the
signs are kept, packed into bits, with correction scalars.  The inner product of a code
and a query (rounded to ``QUERY_BITS`` bits per dimension) is a few ANDs and popcounts;
divided by the code's own inner product it estimates the cosine without bias, and the
scalars bound the error.  A vector is compared in full precision only if its upper bound
reaches the ``k``-th largest lower bound of its block, each id counted once.

The index is a table of blocks, and so are the queries (a stated set).  Every query
block meets every index block by an equality join on the block number, so a task holds
one block of each; what leaves a block is ``k`` rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import held

NEIGHBOURS = 5
STRETCH = 8
QUERY_BITS = 6
#: Standard errors of an estimate inside its bounds.
CONFIDENCE = 3.0
BLOCK_ROWS = 8192
QUERY_ROWS = 512
SEED = 11


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """``dim`` orthonormal rows of ``code_bits(dim)`` columns, uniformly random."""
    rng = np.random.Generator(np.random.PCG64([seed, dim]))
    q, r = np.linalg.qr(rng.normal(size=(code_bits(dim), dim)))
    return (q * np.sign(np.diag(r))).T


def code_bits(dim: int) -> int:
    return -(-dim * STRETCH // 64) * 64


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, also where squares would overflow or vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Codes:
    """One-bit codes of unit vectors and the scalars that correct their estimates."""

    def __init__(self, unit: np.ndarray, centre: np.ndarray):
        dim = unit.shape[1]
        rest = unit - centre
        self.norm = np.linalg.norm(rest, axis=1)
        turned = (rest / np.maximum(self.norm, 1e-300)[:, None]) @ rotation(dim)
        bits = turned > 0
        self.words = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        self.ones = bits.sum(axis=1)
        # Inner product of the code with what it stands for.
        self.own = np.abs(turned).sum(axis=1) / np.sqrt(bits.shape[1])
        self.offset = unit @ centre
        self.bits = bits.shape[1]

    def bounds(self, query: np.ndarray, centre: np.ndarray, confidence: float = CONFIDENCE
               ) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines of all coded vectors with one unit query, and the error bounds."""
        rest = query - centre
        norm = np.linalg.norm(rest)
        turned = rest / max(norm, 1e-300) @ rotation_of(len(query))
        low = turned.min()
        step = max((turned.max() - low) / ((1 << QUERY_BITS) - 1), 1e-300)
        rounded = np.rint((turned - low) / step).astype(np.int64)
        total = np.zeros(len(self.words), np.int64)
        for k in range(QUERY_BITS):
            plane = np.packbits((rounded >> k & 1).astype(bool), bitorder="little").view(np.uint64)
            total += np.bitwise_count(self.words & plane).sum(axis=1, dtype=np.int64) << k
        root = np.sqrt(self.bits)
        product = (2 * step * total + 2 * low * self.ones - step * rounded.sum()) / root - low * root
        rounding = np.linalg.norm(turned - low - step * rounded)
        own = np.maximum(self.own, 1e-12)
        scale = self.norm * norm
        estimate = scale * product / own + self.offset + centre @ rest
        error = scale * (confidence * np.sqrt(np.maximum(1 - own * own, 0) / (self.bits - 1)) + rounding) / own
        return estimate, error + 1e-12


_rotations: dict[int, np.ndarray] = {}


def rotation_of(dim: int) -> np.ndarray:
    if dim not in _rotations:
        _rotations[dim] = rotation(dim)
    return _rotations[dim]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), dim)


def _pack(rows: int):
    """Rows ``id, vector, dim`` to blocks of one dimension, numbered by partition and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids = np.concatenate([x for x, _ in waiting[dim]])
            vectors = np.concatenate([v for _, v in waiting[dim]])
            waiting[dim] = []
            made += 1
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + made]), pa.array([dim], pa.int32()),
                pa.array([ids.astype(np.int64).tobytes()]), pa.array([vectors.tobytes()])],
                ["block", "dim", "ids", "vectors"])

        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                mine = batch.filter(pa.array(dims == dim))
                for at in range(0, mine.num_rows, rows):
                    some = mine.slice(at, rows)
                    waiting.setdefault(dim, []).append(
                        (some.column(0).to_numpy(), _matrix(some.column(1), dim)))
                    if sum(len(x) for x, _ in waiting[dim]) >= rows:
                        yield block(dim)
        for dim in sorted(waiting):
            if waiting[dim]:
                yield block(dim)
    return run


def blocks(vectors: DataFrame, vec_id: str, embedding: str, rows: int) -> DataFrame:
    usable_rows = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(embedding)))
    return usable_rows.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("vector"),
                              F.size(embedding).alias("dim")).mapInArrow(
        _pack(rows), "block long, dim int, ids binary, vectors binary")


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, ids, raw in zip(*(batch.column(c).to_pylist() for c in range(1, 4))):
            unit = units(np.frombuffer(raw, np.float64).reshape(-1, dim))
            yield pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()), pa.array([len(unit)]), pa.array([unit.sum(axis=0).tolist()])],
                ["dim", "n", "total"])


def centres(index: DataFrame) -> dict[int, np.ndarray]:
    """Mean unit vector of each dimension."""
    sums = index.mapInArrow(_centres, "dim int, n long, total array<double>")
    each = sums.select("dim", "n", F.posexplode("total").alias("at", "x"))
    rows = each.groupBy("dim", "at").agg((F.sum("x") / F.sum("n")).alias("x")).collect()
    found: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["dim"], r["at"])):
        found.setdefault(r["dim"], []).append(r["x"])
    return {dim: np.array(x) for dim, x in found.items()}


def _code(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, dim, ids, raw in zip(*(batch.column(c).to_pylist() for c in range(4))):
                vectors = np.frombuffer(raw, np.float64).reshape(-1, dim)
                c = Codes(units(vectors), shared.value[dim])
                scalars = np.stack([c.norm, c.own, c.offset, c.ones.astype(np.float64)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), pa.array([dim], pa.int32()), pa.array([ids]), pa.array([raw]),
                    pa.array([c.words.tobytes()]), pa.array([scalars.tobytes()])],
                    ["block", "dim", "ids", "vectors", "codes", "scalars"])
    return run


def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                rows: int = BLOCK_ROWS) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The index table (ids, vectors, codes and scalars, block by block) and its centres."""
    packed = held(blocks(vectors, vec_id, embedding, rows), "vectors")
    mean = centres(packed)
    shared = vectors.sparkSession.sparkContext.broadcast(mean)      # one vector per dimension
    coded = packed.mapInArrow(_code(shared), "block long, dim int, ids binary, vectors binary, "
                                             "codes binary, scalars binary")
    return held(coded, "index"), mean


def _search(shared, k: int, confidence: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim, ids, raw, words, scalars, q_ids, q_raw = (
                    batch.column(c)[r].as_py() for c in range(7))
                ids = np.frombuffer(ids, np.int64)
                vectors = np.frombuffer(raw, np.float64).reshape(-1, dim)
                unit = units(vectors)
                c = Codes.__new__(Codes)
                c.bits = code_bits(dim)
                c.words = np.frombuffer(words, np.uint64).reshape(-1, c.bits // 64)
                c.norm, c.own, c.offset, c.ones = np.frombuffer(scalars, np.float64).reshape(4, -1)
                mean = shared.value[dim]
                # Rows of one id stand together in this order.
                by = np.argsort(ids, kind="stable")
                starts = np.flatnonzero(np.diff(ids[by], prepend=ids[by[0]] - 1))
                out: list[list] = [[], [], []]
                queries = units(np.frombuffer(q_raw, np.float64).reshape(-1, dim))
                for q, query in zip(np.frombuffer(q_ids, np.int64), queries):
                    estimate, error = c.bounds(query, mean, confidence)
                    mine = ids == q
                    estimate[mine] = -np.inf
                    lower = np.maximum.reduceat((estimate - error)[by], starts)
                    least = np.partition(lower, -k)[-k] if len(lower) > k else -np.inf
                    near = np.flatnonzero((estimate + error >= least) & ~mine)
                    # Row by row: equal vectors get equal bits wherever they stand.
                    cosine = (unit[near] * query).sum(axis=1)
                    best = np.lexsort((ids[near], -cosine))
                    _, once = np.unique(ids[near][best], return_index=True)
                    best = best[np.sort(once)[:k]]
                    out[0].append(np.full(len(best), q))
                    out[1].append(ids[near][best])
                    out[2].append(cosine[best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding",
            k: int = NEIGHBOURS, confidence: float = CONFIDENCE, rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest cosine to each query.

    Queries are the rows of ``vectors`` with ``is_query``; candidates are all rows but
    those with the query's own id, of the same dimension.  Null ids, and vectors that
    are null, empty, zero or not finite, take no part.  Equal scores go to the smaller
    id; a repeated id is one candidate, by its best score, and one query, by its smallest
    vector.
    """
    spark = vectors.sparkSession
    index, mean = build_index(vectors, vec_id, embedding, rows)
    wanted = vectors.where(is_query & usable(F.col(embedding))).groupBy(vec_id).agg(
        F.min(embedding).alias(embedding))
    queries = held(blocks(wanted, vec_id, embedding, query_rows), "queries").select(
        "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    # Every query block is sent to the number of every index block of its dimension.
    numbers = index.groupBy("dim").agg(F.collect_set("block").alias("numbers"))
    sent = queries.join(numbers, "dim").select(
        "dim", "q_ids", "q_vectors", F.explode("numbers").alias("block"))
    pairs = index.join(sent, ["block", "dim"]).select(
        "dim", "ids", "vectors", "codes", "scalars", "q_ids", "q_vectors")
    shared = spark.sparkContext.broadcast(mean)
    found = pairs.mapInArrow(_search(shared, k, confidence), "query_id long, vec_id long, score double")
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
