"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of documents of about ``SHARD_BYTES`` inside a task.  Its words
become numbers: words that no test phrase uses and the ends of documents are one and
the same separator, so runs too short for any phrase are left out before indexing.
The Burrows-Wheeler transform of the numbers is held in a wavelet matrix with
popcount ranks; every phrase is found by backward search, all phrases of a block at
once, and its occurrences are located by walking back to sampled suffix positions.

Phrases are *windows*: ``WINDOW`` consecutive words of an item, or a shorter item as a
whole.  Spans of occurrences are merged per document.  Documents are never shuffled.

Test items of any number are worked off in blocks of at most ``PHRASE_WORDS`` words,
one pass over the documents each, so what the driver sends out is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_ALNUM, Words, chunks, split_words

WINDOW = 10
SHARD_BYTES = 2 << 20
SAMPLE = 16
PHRASE_WORDS = 1 << 19
GAP, END = 1, 0     # symbols: separator, end of the shard; test words come after them


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; only suffixes that are still tied are sorted.

    ``text`` ends with a symbol that is smaller than all others.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    key = text[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    alone = new & np.append(new[1:], True)
    tied = np.flatnonzero(~alone)           # places in ``order``
    width = 1
    while len(tied):
        suffix = order[tied]
        group = rank[suffix]
        nxt = rank[np.minimum(suffix + width, n - 1)]
        by = np.argsort(group * np.int64(n) + nxt, kind="stable")
        suffix, group, nxt = suffix[by], group[by], nxt[by]
        order[tied] = suffix
        new = np.ones(len(tied), bool)
        new[1:] = (group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])
        first = np.flatnonzero(new)
        rank[suffix] = np.repeat(tied[first], np.diff(np.append(first, len(tied))))
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
        width *= 2
    return order


class WaveletMatrix:
    """Ranks and symbols of a sequence of small numbers, for arrays of arguments."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for k in range(bits - 1, -1, -1):
            bit = (symbols >> k & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((k, words, before, len(bit) - int(bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[i >> 6] + np.bitwise_count(words[i >> 6] & mask)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before place ``i``."""
        low = np.zeros_like(i)
        for k, words, before, zeros in self.levels:
            one = (symbol >> k & 1).astype(bool)
            a, b = self._ones(words, before, low), self._ones(words, before, i)
            low = np.where(one, zeros + a, low - a)
            i = np.where(one, zeros + b, i - b)
        return i - low

    def symbol(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for _, words, before, zeros in self.levels:
            one = (words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            a = self._ones(words, before, i)
            out = out << 1 | one
            i = np.where(one, zeros + a, i - a)
        return out


class FMIndex:
    """FM-index of numbers below ``2**bits``; the last must be the only ``END``."""

    def __init__(self, text: np.ndarray, bits: int, sample: int = SAMPLE):
        n = len(text)
        order = suffix_array(text)
        self.n = n
        self.bwt = WaveletMatrix(text[order - 1], bits)
        self.before = np.zeros((1 << bits) + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=1 << bits), out=self.before[1:])
        kept = order % sample == 0
        self.sampled = WaveletMatrix(kept.astype(np.int64), 1)
        self.places = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``low:high`` of the suffixes that start with each phrase (padded on the left)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            alive = alive[(lengths[alive] >= phrases.shape[1] - j) & (high[alive] > low[alive])]
            if not len(alive):
                break
            c = phrases[alive, j]
            low[alive] = self.before[c] + self.bwt.rank(c, low[alive])
            high[alive] = self.before[c] + self.bwt.rank(c, high[alive])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows."""
        out = np.zeros(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        rows, todo = rows.copy(), np.arange(len(rows))
        while len(todo):
            at = rows[todo]
            known = self.sampled.symbol(at).astype(bool)
            ones = self.sampled.rank(np.ones(known.sum(), np.int64), at[known])
            out[todo[known]] = self.places[ones] + steps[todo[known]]
            todo, at = todo[~known], at[~known]
            c = self.bwt.symbol(at)
            rows[todo] = self.before[c] + self.bwt.rank(c, at)
            steps[todo] += 1
        return out


class Phrases:
    """Distinct windows of a block of test items, as numbers of a sorted vocabulary."""

    def __init__(self, items: list[str], texts: list[str | None], window: int = WINDOW):
        hashes, first = [], [0]
        for _, _, data, base in chunks(pa.array(texts, pa.string())):
            words = split_words(data, base, NOT_ALNUM, True)
            hashes.append(words.hashes)
            first += (first[-1] + words.first[1:]).tolist()
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(flat)
        numbers = np.searchsorted(self.vocabulary, flat) + 2
        self.bits = max(2, int(len(self.vocabulary) + 1).bit_length())
        self.items = items
        first = np.array(first, np.int64)
        size = np.diff(first)
        # Every window of every item, padded on the left; then each distinct one with its items.
        windows = np.where(size > 0, np.maximum(size - window, 0) + 1, 0)
        item = np.repeat(np.arange(len(items)), windows)
        begin = np.arange(len(item)) - (np.cumsum(windows) - windows)[item] + first[:-1][item]
        length = np.minimum(size, window)[item]
        column = np.arange(window)[None, :] - (window - length)[:, None]
        rows = np.where(column >= 0, numbers[np.minimum(begin[:, None] + np.maximum(column, 0), max(0, len(numbers) - 1))]
                        if len(numbers) else 0, 0).astype(np.int32)
        order = np.lexsort(rows.T[::-1])
        rows, item, length = rows[order], item[order], length[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        self.table, self.lengths = rows[new].astype(np.int64), length[new].astype(np.int64)
        #: Numbers of the items that own each phrase, in a row; ``edges`` cut it.
        self.owner, self.edges = item, np.append(np.flatnonzero(new), len(item))
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0
        slot = self.vocabulary >> np.uint64(44)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[slot] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words: vocabulary numbers, or ``GAP``."""
        out = np.full(len(hashes), GAP, np.int64)
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        place = np.searchsorted(self.vocabulary, hashes[at])
        place[place == len(self.vocabulary)] = 0
        good = self.vocabulary[place] == hashes[at] if len(at) else np.zeros(0, bool)
        out[at[good]] = place[good] + 2
        return out


def find_phrases(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(phrase, first word, end word)`` of every occurrence in the shard ``words``."""
    none = np.zeros(0, np.int64)
    if not len(phrases.lengths) or not len(words.hashes):
        return none, none, none
    symbols = phrases.numbers(words.hashes)
    # Runs of test words inside one document.
    joined = np.zeros(len(symbols) + 1, bool)
    joined[:-1] = symbols > GAP
    begin = joined[:-1].copy()
    begin[1:] &= ~joined[:-2]
    starts = words.first[:-1][np.diff(words.first) > 0]
    begin[starts] |= joined[:-1][starts]
    run = np.flatnonzero(begin)
    if not len(run):
        return none, none, none
    stop = joined[:-1].copy()
    stop &= ~joined[1:]
    ends = np.append(starts[1:], len(symbols)) - 1
    stop[ends] |= joined[:-1][ends]
    length = np.flatnonzero(stop) + 1 - run
    keep = length >= phrases.shortest
    run, length = run[keep], length[keep]
    if not len(run):
        return none, none, none
    # The indexed text: each run and a separator, then the end.
    at = np.concatenate([[0], np.cumsum(length + 1)])
    source = np.repeat(run - at[:-1], length + 1) + np.arange(at[-1])
    text = np.full(at[-1] + 1, GAP, np.int64)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    text[:-1][inside] = symbols[source[inside]]
    text[-1] = END
    index = FMIndex(text, phrases.bits)
    low, high = index.search(phrases.table, phrases.lengths)
    counts = high - low
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    found = [index.locate(rows[i:i + (1 << 20)]) for i in range(0, len(rows), 1 << 20)]
    place = source[np.concatenate(found)] if found else none
    return which, place, place + phrases.lengths[which]


def merged(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of spans as maximal ``(first, end)``."""
    out: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), end.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


SPANS = "n_words long, spans array<struct<first:int,end:int,low:int,high:int>>, items array<string>"
SPAN_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()),
                                ("low", pa.int32()), ("high", pa.int32())]))


def _scan(shared, columns: int, keep_text: bool):
    """Appends ``n_words, spans, items`` to rows whose last column is the text."""
    kept = columns if keep_text else columns - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = shared.value
        for batch in batches:
            for row, end, data, base in chunks(batch.column(columns - 1), SHARD_BYTES):
                words = split_words(data, base, NOT_ALNUM, True)
                which, first, stop = find_phrases(words, phrases)
                doc = np.searchsorted(words.first, first, "right") - 1
                by = np.argsort(doc, kind="stable")
                edge = np.searchsorted(doc[by], np.arange(end - row + 1))
                spans, items = [], []
                for d in range(end - row):
                    mine = by[edge[d]:edge[d + 1]]
                    zero, at = int(words.first[d]), int(base[d])
                    spans.append([
                        (a - zero, b - zero, int(words.starts[a]) - at, int(words.ends[b - 1]) - at)
                        for a, b in merged(first[mine], stop[mine])] if len(mine) else [])
                    items.append(sorted({phrases.items[k] for w in set(which[mine].tolist())
                                         for k in phrases.owner[phrases.edges[w]:phrases.edges[w + 1]].tolist()}))
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(row, end - row) for c in range(kept)],
                    pa.array(np.diff(words.first)), pa.array(
                        [[dict(zip(("first", "end", "low", "high"), s)) for s in x] for x in spans], SPAN_TYPE),
                    pa.array(items, pa.list_(pa.string())),
                ], [*batch.schema.names[:kept], "n_words", "spans", "items"])
    return run


def phrase_blocks(items: DataFrame, item_id: str, text: str, limit: int) -> list[DataFrame]:
    """The distinct test items in blocks of about ``limit`` words; one item is never cut."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                        F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + int(total) // (limit * 2)       # a word and its separator: two characters at least
    return [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def contaminated_spans(docs: DataFrame, items: DataFrame, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text",
                       window: int = WINDOW, phrase_words: int = PHRASE_WORDS,
                       keep_text: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words, spans, items`` appended.

    ``spans``: merged runs of hit words, ``first:end`` in words and ``low:high`` in bytes of
    the UTF-8 text, in order.  ``items``: the ids (as strings, sorted) of items with an
    occurring window.  Null and empty texts have no words and no spans; null or empty
    items match nothing; a null item id counts as the empty string; repeated rows each
    get their result; items with the same id count as one.  Columns of ``docs`` named
    like the appended ones are kept under their name with ``_in`` added.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c != text]
    names = {c: f"{c}_in" if c in ("n_words", "spans", "items") else c for c in own}
    held_text = "__scanned_text"
    out = docs.select(*[F.col(f"`{c}`").alias(names[c]) for c in own], F.col(text).alias(held_text))
    blocks = phrase_blocks(items, item_id, item_text, phrase_words)
    for k, block in enumerate(blocks):
        rows = block.collect()              # at most about ``phrase_words`` words
        phrases = Phrases([r["item"] for r in rows], [r["text"] for r in rows], window)
        before = out if not k else out.withColumnsRenamed(
            {"spans": "__spans", "items": "__items"}).drop("n_words")
        before = before.select(*[c for c in before.columns if c != held_text], held_text)
        passed = keep_text or k < len(blocks) - 1
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in before.schema
                           if passed or f.name != held_text)
        out = before.mapInArrow(
            _scan(spark.sparkContext.broadcast(phrases), len(before.columns), passed),
            f"{schema}, {SPANS}")
        if k:
            union = F.expr("""aggregate(array_sort(concat(__spans, spans)),
                cast(array() as array<struct<first:int,end:int,low:int,high:int>>),
                (all, s) -> if(size(all) > 0 AND s.first <= element_at(all, -1).end,
                    concat(slice(all, 1, size(all) - 1), array(named_struct(
                        'first', element_at(all, -1).first,
                        'end', greatest(element_at(all, -1).end, s.end),
                        'low', element_at(all, -1).low,
                        'high', greatest(element_at(all, -1).high, s.high)))),
                    concat(all, array(s))))""")
            out = out.withColumns({
                "spans": union, "items": F.array_sort(F.array_union("__items", "items"))}
            ).drop("__spans", "__items")
    return out.withColumnRenamed(held_text, text)


def without_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """``contaminated_spans``' rows with the spans cut out of the text; ``spans`` stay as they were."""
    pieces = F.expr(f"""transform(sequence(0, size(spans)), i -> decode(substring(
        encode(`{text}`, 'UTF-8'), if(i = 0, 1, spans[i - 1].high + 1),
        if(i = size(spans), octet_length(`{text}`), get(spans, i).low)
        - if(i = 0, 0, spans[i - 1].high)), 'UTF-8'))""")
    return found.withColumn(text, F.when(F.size("spans") > 0, F.array_join(pieces, ""))
                            .otherwise(F.col(f"`{text}`")))
