"""Substring dedup by relative Lempel-Ziv parsing against an index of reference blocks.

A *window* is ``WINDOW`` consecutive words of one document; a word goes when some
window over it also starts anywhere else.  Every window has one *anchor*: the
``ANCHOR``-word gram in it with the smallest hash (the leftmost of equals).  The
anchor depends on the window's words alone, so equal windows meet at equal anchors.

1. *Which anchors repeat.*  Anchor hashes are counted; those seen twice set bits of
   a filter of bounded size.  A false positive costs work, never a result.
2. *Index.*  The windows around one anchor form a block.  The first block (smallest
   document key and place) of each repeated anchor is its reference block.
3. *Match.*  Every other block is held against its reference block; the source of a
   match in the reference is a repeated window too.  Windows that no reference has are
   compared among themselves by count.
4. *Parse.*  Matches that continue each other in document and reference join into the
   longest match.  Each document is parsed from left to right: the match that reaches
   farthest is the next factor, if it has at least ``WINDOW`` words; such a factor is a
   duplicate span.
5. *Factor boundaries.*  Any other window crosses the end of a factor; it is a duplicate
   span if step 3 found it repeated.

Nothing pairs the members of a group: an anchor in a third of all documents is
aggregated before its shuffle, and joined in a join that Spark may split.

Equality of words is equality of 64-bit hashes of the anchor and of the window.
Rows are told apart by ``doc_id`` and a hash of the text, so repeated rows count as
two places and get the same result; a null ``doc_id`` is an id like any other; null
and empty texts have no words.  Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .tables import held
from .words import SPACES, Words, chunks, prefix_hash, span_hash, split_words

WINDOW = 35
ANCHOR = 11
#: Bits of the repeated-anchor filter, at most.
MAX_FILTER_BITS = bloom.MAX_BITS


def sliding_argmin(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the smallest of each ``size`` neighbours, the leftmost of equals."""
    at = np.arange(len(values))
    width = 1
    while width < size:
        step = min(width, size - width)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        width += step
    return at


def anchored_windows(words: Words, window: int, anchor: int):
    """``(window start, window hash, anchor place, anchor hash)`` of a chunk."""
    n = len(words.hashes)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none.astype(np.uint64)
    prefix = prefix_hash(words.hashes)
    gram = np.arange(n - anchor + 1)
    grams = span_hash(prefix, gram, gram + anchor)
    place = sliding_argmin(grams, window - anchor + 1)
    counts = np.diff(words.first)
    fits = np.repeat(words.first[1:], counts)[:len(place)] - np.arange(len(place)) >= window
    start = np.flatnonzero(fits)
    place = place[start]
    return start, span_hash(prefix, start, start + window), place, grams[place]


def _anchor_counts(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, base in chunks(batch.column(0)):
                words = split_words(data, base, SPACES, False)
                _, _, place, hashes = anchored_windows(words, window, anchor)
                first = np.ones(len(place), bool)
                first[1:] = place[1:] != place[:-1]
                found, counts = np.unique(hashes[first], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(counts)], ["anchor", "n"])
    return run


def repeated_anchor_filter(docs: DataFrame, text: str, window: int, anchor: int) -> np.ndarray:
    """A Bloom filter of the anchors that stand at two places or more."""
    counted = (docs.select(F.col(text).alias("text"))
               .mapInArrow(_anchor_counts(window, anchor), "anchor long, n long")
               .groupBy("anchor").agg(F.sum("n").alias("n")))
    return bloom.build(held(counted.where("n > 1").select("anchor"), "anchors"), MAX_FILTER_BITS)


BLOCKS = "anchor long, doc_id long, th long, place int, low int, hashes array<long>"


def _blocks(shared, window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            ids, th = batch.column(0), batch.column(1)
            for row, _, data, base in chunks(batch.column(2)):
                words = split_words(data, base, SPACES, False)
                start, hashes, place, anchors = anchored_windows(words, window, anchor)
                hit = bloom.passes(bitmap, anchors)
                start, hashes, place, anchors = (x[hit] for x in (start, hashes, place, anchors))
                # A block: the windows of one anchor, at successive starts.
                new = np.ones(len(start), bool)
                new[1:] = place[1:] != place[:-1]
                first = np.flatnonzero(new)
                doc = np.searchsorted(words.first, place[first], "right") - 1
                rows = pa.array(row + doc)
                offsets = np.append(first, len(start)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchors[first].view(np.int64)), ids.take(rows), th.take(rows),
                    pa.array((place[first] - words.first[doc]).astype(np.int32)),
                    pa.array((start[first] - place[first]).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64))),
                ], ["anchor", "doc_id", "th", "place", "low", "hashes"])
    return run


def blocks(docs: DataFrame, doc_id: str, text: str, window: int, anchor: int) -> DataFrame:
    """One row per block whose anchor repeats: ``hashes[j]`` is the window at ``place + low + j``."""
    bitmap = repeated_anchor_filter(docs, text, window, anchor)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)   # MAX_FILTER_BITS at most
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"),
                        F.col(text).alias("text"))
    return keyed.mapInArrow(_blocks(shared, window, anchor), BLOCKS)


def duplicate_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Runs of windows that occur elsewhere, with where the reference has them.

    ``doc_id, th, start, n, ref_doc, ref_th, ref_start``: the windows at word
    ``start .. start + n - 1`` of the document equal those at ``ref_start ..`` of the
    reference (null where they were found among themselves, or for the reference
    itself).  Runs of one document may touch or overlap.
    """
    if not 0 < anchor <= window <= anchor + 62:
        raise ValueError("a block's windows must fit in a 63-bit mask")
    found = held(blocks(docs, doc_id, text, window, anchor), "blocks")
    me = F.struct("doc_id", "th", "place", "low", "hashes")
    reference = found.groupBy("anchor").agg(F.min(me).alias("ref"), F.count(F.lit(1)).alias("n"))
    # Written, so that the join is between two plain exchanges and Spark can split a hot anchor.
    reference = held(reference.where("n > 1").select("anchor", "ref"), "reference")
    both = found.join(reference, "anchor")
    is_ref = (F.col("doc_id").eqNullSafe(F.col("ref.doc_id")) & (F.col("th") == F.col("ref.th"))
              & (F.col("place") == F.col("ref.place")))
    # Bit j: the window at this block's offset low + j stands in the reference at the same offset.
    mask = F.expr("""aggregate(sequence(0, size(hashes) - 1), 0L, (bits, j) -> bits | if(
        hashes[j] = get(ref.hashes, j + low - ref.low), shiftleft(1L, j), 0L))""")
    matched = held(both.select(
        "anchor", "doc_id", "th", "place", "low", is_ref.alias("is_ref"),
        F.struct("ref.doc_id", "ref.th", "ref.place", "ref.low",
                 F.size("ref.hashes").alias("size")).alias("source"),
        mask.alias("mask"),
        F.when(~is_ref, F.col("hashes")).alias("hashes"),
    ), "matched")

    def runs(frame: DataFrame, extra: list) -> DataFrame:
        """Maximal runs of set bits of ``mask`` as ``(start, n)``."""
        size = window - anchor + 1
        begins = F.expr(f"filter(sequence(0, {size - 1}), j -> mask & shiftleft(1L, j) <> 0L"
                        " AND (j = 0 OR mask & shiftleft(1L, j - 1) = 0L))")
        ends = F.expr(f"filter(sequence(0, {size - 1}), j -> mask & shiftleft(1L, j) <> 0L"
                      " AND mask & shiftleft(1L, j + 1) = 0L)")
        zipped = F.arrays_zip(begins.alias("b"), ends.alias("e"))
        return (frame.select(*extra, F.explode(zipped).alias("r"))
                .withColumn("start", F.col("place") + F.col("low") + F.col("r.b"))
                .withColumn("n", F.col("r.e") - F.col("r.b") + 1).drop("r"))

    blank = [F.lit(None).cast(t).alias(c) for c, t in
             (("ref_doc", "long"), ("ref_th", "long"), ("ref_start", "int"))]
    others = runs(matched.where("NOT is_ref AND mask <> 0"),
                  ["doc_id", "th", "place", "low", "source", "mask"]).select(
        "doc_id", "th", "start", "n", F.col("source.doc_id").alias("ref_doc"),
        F.col("source.th").alias("ref_th"),
        (F.col("start") - F.col("place") + F.col("source.place")).cast("int").alias("ref_start"))

    # What of the reference block is matched by anything, seen from its own offsets.
    on_source = F.expr("""if(low >= source.low, shiftleft(mask, low - source.low),
                              shiftrightunsigned(mask, source.low - low))""")
    hit = (matched.groupBy("anchor").agg(
        F.first("source").alias("s"),
        F.bit_or(F.when(~F.col("is_ref"), on_source).otherwise(F.expr("0L"))).alias("hits"),
        F.sum(F.col("is_ref").cast("long")).alias("copies")))
    hit = hit.select("s.doc_id", "s.th", "s.place", "s.low", F.expr(
        "if(copies > 1, shiftleft(1L, s.size) - 1L, hits)").alias("mask"))
    sources = runs(hit.where("mask <> 0"), ["doc_id", "th", "place", "low", "mask"]).select(
        "doc_id", "th", "start", "n", *blank)

    # Factor boundaries: windows that no reference has, compared among themselves.
    left = matched.where("NOT is_ref").select(
        "anchor", "doc_id", "th", "place", "low", "mask", F.posexplode("hashes").alias("j", "hash"))
    left = left.where(F.expr("mask & shiftleft(1L, j) = 0L")).select(
        "anchor", "hash", (F.col("low") + F.col("j")).alias("offset"), "doc_id", "th", "place")
    again = held(left.groupBy("anchor", "hash", "offset").agg(F.count(F.lit(1)).alias("c"))
                 .where("c > 1").drop("c"), "again")
    crossing = left.join(again, ["anchor", "hash", "offset"]).select(
        "doc_id", "th", (F.col("place") + F.col("offset")).cast("int").alias("start"),
        F.lit(1).alias("n"), *blank)
    kinds = {"start": "int", "n": "int"}
    parts = [p.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})
             for p in (others, sources, crossing)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SPANS = "array<struct<start:int,length:int,ref_doc:long,ref_th:long,ref_start:int>>"
SPAN_FIELDS = (("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_th", pa.int64()),
               ("ref_start", pa.int32()))


def longest_matches(row: np.ndarray, ref: list[np.ndarray], gap: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Word matches ``start .. end`` that meet on one line of one reference, joined; sorted by row and start.

    Returns the first of the joined matches (as places in the arguments), and their ends.
    """
    order = np.lexsort((start, gap, *ref, row))
    keys = [x[order] for x in (row, *ref, gap)]
    line = np.zeros(len(order), np.int64)
    if len(order):
        line[1:] = np.cumsum(np.any([x[1:] != x[:-1] for x in keys], axis=0))
    reach = np.maximum.accumulate(end[order] + (line << 32)) - (line << 32)
    first = np.ones(len(order), bool)
    first[1:] = (line[1:] != line[:-1]) | (start[order][1:] > reach[:-1])
    at = np.flatnonzero(first)
    ends = reach[np.append(at[1:], len(order)) - 1] if len(at) else reach
    again = np.lexsort((start[order][at], row[order][at]))
    return order[at][again], ends[again]


def greedy(matches: list[tuple[int, int]], window: int) -> list[tuple[int, int, int]]:
    """Greedy parse by matches ``(start, end)`` in order of start: factors ``(start, end, number of the match)``.

    At each place the match that reaches farthest is taken (the first of equals) if at least
    ``window`` words of it are left; the next factor begins at its end.
    """
    out: list[tuple[int, int, int]] = []
    heap: list[tuple[int, int]] = []
    at = k = 0
    while True:
        while k < len(matches) and matches[k][0] <= at:
            heapq.heappush(heap, (-matches[k][1], k))
            k += 1
        if heap and -heap[0][0] - at >= window:
            out.append((at, -heap[0][0], heap[0][1]))
            at = -heap[0][0]
        elif k < len(matches):      # nothing left here is long enough, so it never will be
            heap.clear()
            at = matches[k][0]
        else:
            return out


def boundary_windows(found: list[tuple[int, int]], parsed: list[tuple[int, int, int]],
                     window: int) -> list[tuple[int, int]]:
    """Of the repeated windows (starts ``low .. high - 1``, in order), those inside no factor, as word spans."""
    out: list[tuple[int, int]] = []
    k, done = 0, 0
    for low, high in found:
        low = max(low, done)
        while low < high:
            while k < len(parsed) and parsed[k][1] - window < low:
                k += 1
            if k < len(parsed) and parsed[k][0] <= low:
                low = parsed[k][1] - window + 1
                continue
            stop = min(high, parsed[k][0]) if k < len(parsed) else high
            if out and low <= out[-1][1] - window + 1:
                out[-1] = (out[-1][0], stop + window - 1)
            else:
                out.append((low, stop + window - 1))
            low = stop
        done = max(done, high)
    return out


def _parse(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(2)
            row = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
            flat = runs.flatten()
            start, n, ref_start = (flat.field(c).fill_null(0).to_numpy().astype(np.int64)
                                   for c in ("start", "n", "ref_start"))
            ref_doc, ref_th = flat.field("ref_doc"), flat.field("ref_th")
            has = np.flatnonzero(ref_th.is_valid().to_numpy(zero_copy_only=False))
            ref = [x.to_numpy(zero_copy_only=False)[has] for x in (
                ref_doc.is_null(), ref_doc.fill_null(0), ref_th.fill_null(0))]
            first, ends = longest_matches(row[has], ref, (ref_start - start)[has], start[has],
                                          (start + n + window - 1)[has])
            first = has[first]
            match_rows = np.searchsorted(row[first], np.arange(len(runs) + 1))
            order = np.lexsort((start, row))
            window_rows = np.searchsorted(row[order], np.arange(len(runs) + 1))
            matches = list(zip(start[first].tolist(), ends.tolist()))
            found = list(zip(start[order].tolist(), (start + n)[order].tolist()))
            out: list[list] = [[] for _ in range(3)]        # start, length, place of the match in ``flat`` or None
            offsets = [0]
            for r in range(len(runs)):
                low, high = match_rows[r:r + 2].tolist()
                parsed = greedy(matches[low:high], window)
                for begin, end, k in parsed:
                    out[0].append(begin)
                    out[1].append(end - begin)
                    out[2].append(int(first[low + k]))
                a, b = window_rows[r:r + 2].tolist()
                for begin, end in boundary_windows(found[a:b], parsed, window):
                    out[0].append(begin)
                    out[1].append(end - begin)
                    out[2].append(None)
                offsets.append(len(out[0]))
            at = pa.array(out[2], pa.int64())
            source = pa.array([None if k is None else int(ref_start[k] - start[k]) + s
                               for s, k in zip(out[0], out[2])], pa.int32())
            spans = pa.StructArray.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), ref_doc.take(at), ref_th.take(at), source],
                fields=[pa.field(*f) for f in SPAN_FIELDS])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
                ["doc_id", "th", "spans"])
    return run


def parse(runs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, th, spans``: the greedy parse of each document that has a duplicate span.

    Runs that continue each other on one reference are joined into the longest match; from
    left to right the match that reaches farthest becomes a factor, if ``window`` words or
    more are left of it.  Every window inside no factor crosses a factor's end; those among
    them that are known to repeat are the spans without a reference.
    """
    grouped = runs.groupBy("doc_id", "th").agg(        # of one text, so never more than its words
        F.collect_set(F.struct("start", "n", "ref_doc", "ref_th", "ref_start")).alias("runs"))
    return grouped.mapInArrow(_parse(window), f"doc_id long, th long, spans {SPANS}")


def factors(parsed: DataFrame) -> DataFrame:
    """The factors ``(doc_id, th, start, length, ref_doc, ref_th, ref_start)`` of parsed documents."""
    return (parsed.select("doc_id", "th", F.explode("spans").alias("f"))
            .select("doc_id", "th", "f.*").where("ref_th IS NOT NULL"))


def _cut(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(1), batch.column(2)
            out: list[list] = [[], [], []]
            for row, end, data, base in chunks(texts):
                words = split_words(data, base, SPACES, False)
                starts, ends = words.starts.tolist(), words.ends.tolist()
                raw = data.tobytes()
                for d in range(end - row):
                    low, high = int(words.first[d]), int(words.first[d + 1])
                    gone = np.zeros(high - low + 1, np.int64)
                    spans = found[row + d].as_py()
                    for f in spans or ():
                        gone[f["start"]] += 1
                        gone[f["start"] + f["length"]] -= 1
                    kept = (np.cumsum(gone)[:-1] == 0).tolist() if spans else None
                    body = b" ".join([raw[starts[i]:ends[i]] for i in range(low, high)
                                      if kept is None or kept[i - low]])
                    out[0].append(high - low)
                    out[1].append(high - low - sum(kept) if kept else 0 if kept is None else high - low)
                    out[2].append(hashlib.sha256(body).hexdigest() if digest else body.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


def remove_duplicates(docs: DataFrame, parsed: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: each text without the words under its duplicate spans.

    ``kept`` is the remaining words joined by one space, or with ``digest`` its
    SHA-256.
    """
    spans = parsed.select(F.col("doc_id").alias("d"), F.col("th").alias("t"),
                          F.transform("spans", lambda f: F.struct(f["start"], f["length"])).alias("spans"))
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"))
    both = keyed.join(spans.hint("shuffle_hash"),
                      F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    return both.select("doc_id", "text", "spans").mapInArrow(
        _cut(digest), "doc_id long, n_words long, n_removed long, kept string")
