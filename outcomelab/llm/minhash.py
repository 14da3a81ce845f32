"""Near-duplicate documents: MinHash, banding, signature check, star components.

A document's set is its distinct ``SHINGLE``-word shingles (the whole sequence when
it has fewer words).  Documents with equal sets form a class; one member, the
smallest id, stands for it.

1. ``HASHES`` universal hash minima of each class, cut into ``BANDS`` bands.  Two sets
   of similarity s share no band with probability (1 - s**4)**32: 5e-8 at 0.8.
2. *Star.*  In each bucket every class is proposed to the bucket's smallest id.
   Proposals must pass the signatures first and then the full sets.
3. *Components* by alternating large-star and small-star.
4. *The rest of a bucket.*  Where a bucket still holds several components, members
   outside the largest are compared with all members, block by block inside the
   tasks: on signatures, then on full sets.  Pairs stay inside the tasks, also those
   that only the signatures let through; what is written is each block's members that
   agree with any other, and at most a spanning forest of links.  Buckets whose
   members hang together, however many there are, cost nothing here.

So no group is paired with itself, and the components are those of all links found
by banding.

Ids: rows with one and the same ``doc_id`` count as one document; a row without one
gets an internal id after all others and its component is null unless a row with an
id is in it.  With ``by_text`` a document is an id and its text, so that unrelated texts
whose ids clash are neither linked nor dropped for one another.  Null and empty texts are
linked with nothing.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .components import components
from .tables import held
from .words import SPACES, chunks, mix, prefix_hash, span_hash, split_words

SHINGLE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: A signature may fall short of the similarity by so many standard errors.
ERRORS = 5.0
#: Members of a bucket that one task compares at a time.
BLOCK = 512
GRID = ["key", "block", "visit"]

_rng = np.random.Generator(np.random.PCG64(20))
FACTORS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
OFFSETS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of ``a * x + b`` modulo 2**32 over the shingles, one for each hash."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        h = FACTORS[:, None] * x[None, at:at + 4096] + OFFSETS[:, None]
        np.minimum(low, h.min(axis=1), out=low)
    return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band and row of ``signatures``."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = mix(key ^ mix(parts[:, :, r]), r)
    return key


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for row, end, data, base in chunks(column):
        words = split_words(data, base, SPACES, True)
        starts, hashes = words.windows(size)
        at = np.searchsorted(starts, words.first)
        prefix = prefix_hash(words.hashes)
        for d in range(end - row):
            low, high = words.first[d], words.first[d + 1]
            if high - low >= size:
                yield np.unique(hashes[at[d]:at[d + 1]])
            elif high > low:
                yield span_hash(prefix, np.array([low]), np.array([high]))
            else:
                yield np.zeros(0, np.uint64)


def _set_key(shingles: np.ndarray) -> bytes:
    """128 bits of a set."""
    return np.array([mix(shingles, 1).sum(), mix(shingles, 2).sum()], np.uint64).tobytes()


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, signs = [], [], []
            for s in shingle_sets(batch.column(1), size):
                n.append(len(s))
                keys.append(_set_key(s) if len(s) else None)
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(signs, pa.binary())], ["node", "n_shingles", "set_key", "sign"])
    return run


def _node(doc_id: str, text: str) -> Column:
    """A hash of the id and the text of a row, either of which may be null."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id).cast("long"), F.col(text).isNull(), F.col(text))


def _numbers(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Fixed-width binaries as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = band_keys(_numbers(batch.column(1), np.uint32, HASHES))
        offsets = np.arange(0, keys.size + 1, BANDS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64)))], ["id", "keys"])


def _agreeing(least: float):
    """Keeps the pairs whose signatures agree in a share of at least ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_numbers(batch.column(c), np.uint32, HASHES) for c in (2, 3))
            good = (x == y).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good)) for c in (0, 1)], ["a", "b"])
    return run


def _wanted_sets(shared, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            mine = pa.array(bloom.passes(shared.value, nodes.view(np.uint64)))
            ids, texts = batch.column(0).filter(mine), batch.column(1).filter(mine)
            keys, sets = [], []
            for s in shingle_sets(texts, size):
                keys.append(_set_key(s) if len(s) else None)
                sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                ["id", "set_key", "members"])
    return run


def _similar(num: int, den: int):
    """Keeps the pairs with ``den * intersection >= num * union`` of their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                good.append(_enough(x, y, num, den))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(good) for c in (0, 1)], ["a", "b"])
    return run


def _least_agreement(num: int, den: int) -> float:
    s = num / den
    return s - ERRORS * np.sqrt(s * (1 - s) / HASHES)


def _enough(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both)


class _Linker:
    """Proposed pairs of classes go in, links confirmed on full sets come out."""

    def __init__(self, docs: DataFrame, classes: DataFrame, num: int, den: int, size: int):
        self.docs, self.classes = docs, classes
        self.num, self.den, self.size = num, den, size

    def _with(self, pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
        for end, name in (("a", "x"), ("b", "y")):
            side = values.select(F.col("id").alias(end), F.col(value).alias(name))
            pairs = pairs.join(side, end)
        return pairs.select("a", "b", "x", "y")

    def agreeing(self, pairs: DataFrame) -> DataFrame:
        return self._with(pairs, self.classes, "sign").mapInArrow(
            _agreeing(_least_agreement(self.num, self.den)), "a long, b long")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``id, members``: the full sets of the classes named in the one column of ``nodes``."""
        nodes = held(nodes.distinct().toDF("id"), "wanted")
        bitmap = bloom.build(nodes)
        shared = self.docs.sparkSession.sparkContext.broadcast(bitmap)     # bloom.MAX_BITS at most
        sets = self.docs.mapInArrow(_wanted_sets(shared, self.size),
                                    "id long, set_key binary, members binary")
        sets = (sets.join(nodes, "id", "left_semi")
                .join(self.classes.select("id", "set_key"), ["id", "set_key"], "left_semi")
                .dropDuplicates(["id", "set_key"]).select("id", "members"))
        return held(sets, "sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` is read more than once: hand in a written table."""
        sets = self.sets(pairs.select("a").union(pairs.select("b")))
        return held(self._with(pairs, sets, "members").mapInArrow(
            _similar(self.num, self.den), "a long, b long"), "links")


def _agreeing_in_cell(bucket: int, table: pa.Table, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Row of a visitor and rows of the members at home whose signatures agree with its own.

    Members of one component, a pair's second meeting in this bucket and pairs that also
    meet in an earlier band are left out.
    """
    ids = table.column("id").to_numpy()
    comp = table.column("component").to_numpy()
    role = table.column("minor").to_numpy(zero_copy_only=False)     # as a visitor
    also = table.column("is_minor").to_numpy(zero_copy_only=False)  # a member that visits too
    signs = _numbers(table.column("sign").combine_chunks(), np.uint32, HASHES)
    keys = band_keys(signs)
    band = int(np.flatnonzero((keys == np.uint64(bucket & 0xFFFFFFFFFFFFFFFF)).all(axis=0))[0])
    home = np.flatnonzero(~role)
    for i in np.flatnonzero(role):
        others = home[(comp[home] != comp[i]) & (~also[home] | (ids[home] > ids[i]))]
        others = others[(signs[others] == signs[i]).mean(axis=1) >= least]
        others = others[~(keys[others, :band] == keys[i, :band]).any(axis=1)]
        if len(others):
            yield int(i), others


def _named_in_cell(least: float):
    """The rows of one block of members and one of visitors that agree with any row of the other."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        named = np.zeros(len(table), bool)
        for i, others in _agreeing_in_cell(key[0].as_py(), table, least):
            named[i] = named[others] = True
        return table.filter(pa.array(named))
    return run


def _link_in_cell(least: float, num: int, den: int):
    """Links of one cell, confirmed on full sets; no more of them than a spanning forest."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table.column("id").to_pylist()
        sets = [np.frombuffer(m.as_buffer(), np.uint64) for m in table.column("members")]
        root = {i: i for i in ids}

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        a, b = [], []
        for i, others in _agreeing_in_cell(key[0].as_py(), table, least):
            for j in others:
                x, y = ids[i], ids[j]
                if find(x) != find(y) and _enough(sets[i], sets[j], num, den):
                    root[find(x)] = find(y)
                    a.append(max(x, y))
                    b.append(min(x, y))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    num: int = 8, den: int = 10, size: int = SHINGLE,
                    same_id: DataFrame | None = None) -> DataFrame:
    """``node, n_shingles, component``: one row per input row.

    Rows are linked when ``den * |A & B| >= num * |A | B|``.  ``node`` is a hash of the
    row's ``doc_id`` and text, so texts that share an id are told apart; ``component`` is
    the smallest node reachable.  ``same_id`` adds links ``a, b`` between nodes.
    """
    keyed = docs.select(_node(doc_id, text).alias("node"), F.col(text).alias("text"))
    signed = held(keyed.mapInArrow(
        _sign(size), "node long, n_shingles long, set_key binary, sign binary"), "signed")
    full = signed.where("set_key IS NOT NULL")
    classes = held(full.groupBy("set_key").agg(F.min("node").alias("id"), F.first("sign").alias("sign")),
                   "classes")
    copies = full.select("node", "set_key").join(classes.select("set_key", "id"), "set_key")
    copies = held(copies.where("node <> id").select(F.col("node").alias("a"), F.col("id").alias("b")),
                  "copies")
    linker = _Linker(keyed, classes, num, den, size)

    bands = (classes.select("id", "sign").mapInArrow(_bands, "id long, keys array<long>")
             .select("id", F.explode("keys").alias("key")))
    centres = bands.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("n"))
    members = held(bands.join(centres.where("n > 1").drop("n"), "key"), "members")
    pairs = members.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    links = linker.confirmed(held(linker.agreeing(pairs.distinct()), "proposed"))
    known = copies.union(links) if same_id is None else copies.union(links).union(same_id)
    found = held(components(known), "found")

    # The rest: buckets that still hold several components.
    # Links by id alone are no reason to compare less: they join what is compared anyway.
    side = found.select(F.col("node").alias("id"), "component")
    placed = members.select("key", "id").join(side, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    groups = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = groups.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("c"))
    buckets = buckets.where("c > 1").select(
        "key", F.col("largest.component").alias("main"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("largest.n")) / BLOCK).cast("int").alias("visits"))
    open_members = held(placed.join(buckets, "key").select(
        "key", "id", "component", (F.col("component") != F.col("main")).alias("is_minor"),
        "blocks", "visits"), "open")
    if not open_members.isEmpty():
        # A bucket is a grid of member blocks by blocks of minor members.
        place = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        line = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        at_home = open_members.select(
            "key", "id", "component", "is_minor", F.lit(False).alias("minor"),
            place("blocks").alias("block"), F.explode(line("visits")).alias("visit"))
        visiting = open_members.where("is_minor").select(
            "key", "id", "component", "is_minor", F.lit(True).alias("minor"),
            F.explode(line("blocks")).alias("block"), place("visits").alias("visit"))
        spread = at_home.union(visiting).join(classes.select("id", "sign"), "id")
        # A first pass names the rows whose sets are needed; the second finds their pairs anew.
        least = _least_agreement(num, den)
        named = held(spread.groupBy(*GRID).applyInArrow(_named_in_cell(least), spread.schema), "named")
        sets = linker.sets(named.select("id"))
        more = held(named.join(sets, "id").groupBy(*GRID).applyInArrow(
            _link_in_cell(least, num, den), "a long, b long").distinct(), "links")
        # The stars that are there, and the links between them.
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(stars.union(more))
    return signed.select("node", "n_shingles").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def document_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        num: int = 8, den: int = 10, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per input row.

    Rows with one ``doc_id`` are one document of the graph, whatever their texts, and each
    gets its own row.  ``component_id`` is the smallest id reachable (any 64-bit number).
    A row without an id stands for itself; its ``component_id`` is null where no row with
    an id is near.  ``kept``: the two ids are equal, or both null.
    """
    ids = held(docs.select(_node(doc_id, text).alias("node"), F.col(doc_id).cast("long").alias("doc_id")).distinct(),
               "ids")
    hubs = ids.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    same = ids.join(hubs, "doc_id").where("node <> b").select(F.col("node").alias("a"), "b")
    found = held(near_duplicates(docs, doc_id, text, num, den, size, same), "components").join(ids, "node")
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "component").select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, result: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: one of its smallest id; all columns.

    ``result`` is what ``near_duplicates`` returned for ``docs``.  Of several texts with
    the id that is kept, the one with the smallest hash stays, and of equal rows one.
    Rows without an id stand for themselves where no row with an id is near.
    """
    node = _node(doc_id, text)
    # Nodes are hashes: the smallest id of a component is looked up.
    ids = docs.select(node.alias("node"), F.col(doc_id).cast("long").alias("id")).distinct()
    each = result.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n")).join(ids, "node")
    least = each.groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node", "n")).alias("least"))
    nodes = held(least.select(F.col("least.node").alias("__kept"), F.col("least.n").alias("__rows")), "kept")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("__row"), node.alias("__node"))

    def with_rows(condition: str) -> DataFrame:
        # Both joins read the same columns, so the rows are shuffled once.
        some = nodes.where(condition).select("__kept").hint("shuffle_hash")
        return keyed.join(some, F.col("__node") == F.col("__kept"), "left_semi")

    once = with_rows("__rows = 1")
    first = Window.partitionBy("__node").orderBy(F.col("__row")[text])
    often = with_rows("__rows > 1").withColumn("__at", F.row_number().over(first)).where("__at = 1")
    return once.select("__row.*").unionByName(often.select("__row.*"))
