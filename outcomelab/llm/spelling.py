"""Spelling variants: words of a vocabulary that differ by one character, found in FM-indexes.

Two words at one insertion, deletion or replacement share one of the halves of either of
them.  So every word asks twice: its front half is matched exactly and then extended to
the right over the back half with one error, and its back half is extended to the left
over the front half.  Both run on a *bidirectional* FM-index of the delimited vocabulary
(``$word$word$``): an interval of suffix ranks of the text and one of the reversed text
are kept in step, so a half that was matched in one direction is extended in the other.
The interval of a whole ``$word$`` is the word's rank in the sorted vocabulary.

The vocabulary is dealt by halves: a word is indexed in the buckets of the halves that its
neighbours can have and asks in those of its own two.  A bucket of more than ``INDEXED``
words is cut into several indexes, and one that many words ask is asked in several tasks.
Neighbours are counted where they are found; pairs are never written.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import WaveletMatrix, suffix_array
from .tables import held
from .words import chunks

RUN = re.compile("[a-zÀ-ÿ]+")
#: Words of one index, and words that ask it in one task.
INDEXED, ASKING = 1 << 15, 1 << 17
#: Distinct words that a task counts before it hands them on.
COUNTED = 1 << 18
#: Words asked at once times the length of the longest of them.
CELLS = 1 << 17
END, MARK, UNKNOWN = 0, 1, -1


# Word counts

def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = 6,
                least_count: int = 5, slip: int | None = None) -> DataFrame:
    """``word, n`` of the runs of letters in whole texts, A-Z lower-cased.

    Words of fewer than ``least_length`` code points or ``least_count`` occurrences are left
    out.  With ``slip``, a run of a document whose CRC-32 of ``<id>:<run>`` is a multiple of
    ``slip`` loses the code point at that CRC modulo its length before it is counted.  A null
    text has no words, a null id counts as an empty one, and repeated rows count repeatedly.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, data, base in chunks(batch.column(1)):
                for k in range(high - low):
                    said = data[base[k]:base[k + 1]].tobytes().lower().decode()     # bytes: A-Z only
                    found = Counter(w for w in RUN.findall(said) if len(w) >= least_length)
                    if slip:
                        start = zlib.crc32(f"{ids[low + k] or ''}:".encode())
                        for w, n in found.items():
                            h = zlib.crc32(w.encode(), start)
                            if h % slip == 0:
                                at = h % len(w)
                                w = w[:at] + w[at + 1:]
                                if len(w) < least_length:
                                    continue
                            counts[w] += n
                    else:
                        counts.update(found)
                    if len(counts) >= COUNTED:
                        yield out()
        yield out()

    parts = docs.select(F.col(id).cast("string"), F.col(text)).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# The index

class BidirectionalIndex:
    """Suffix-rank intervals of a text of numbers and of its reverse, kept in step.

    A state is ``(low, low of the reverse, size)`` for the pattern matched so far.
    """

    def __init__(self, text: np.ndarray, bits: int):
        self.bits, self.n = bits, len(text) + 1
        self.bwt = []
        for way in (text, text[::-1]):
            whole = np.append(way, END)
            self.bwt.append(WaveletMatrix(whole[suffix_array(whole) - 1], bits))
        self.before = np.zeros((1 << bits) + 1, np.int64)
        np.cumsum(np.bincount(np.append(text, END), minlength=1 << bits), out=self.before[1:])
        self.start = []
        for tree in self.bwt:       # where each symbol's block begins below the last level
            at, symbols = np.zeros(1 << bits, np.int64), np.arange(1 << bits)
            for k, words, ones, zeros in tree.levels:
                a = tree._ones(words, ones, at)
                at = np.where(symbols >> k & 1, zeros + a, at - a)
            self.start.append(at)

    def everywhere(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.n, np.int64)

    def extend(self, state, symbol: np.ndarray, right: bool):
        """The states after one more ``symbol`` on the left or right; of size 0 where it does not stand."""
        tree = self.bwt[right]
        low, other, size = (state[1], state[0], state[2]) if right else state
        known = symbol >= 0
        c = np.where(known, symbol, 0)
        a, b, smaller = low, low + size, np.zeros_like(low)
        for k, words, ones, zeros in tree.levels:
            one = (c >> k & 1).astype(bool)
            x, y = tree._ones(words, ones, a), tree._ones(words, ones, b)
            smaller += np.where(one, (b - y) - (a - x), 0)
            a, b = np.where(one, zeros + x, a - x), np.where(one, zeros + y, b - y)
        at, beside = self.before[c] + a - self.start[right][c], other + smaller
        size = np.where(known, b - a, 0)
        return (beside, at, size) if right else (at, beside, size)

    def branches(self, state, right: bool):
        """``(number of the state, symbol, state after it)`` for every symbol that stands there."""
        tree = self.bwt[right]
        low, other, size = (state[1], state[0], state[2]) if right else state
        a, b = low, low + size
        symbol, smaller, owner = np.zeros_like(low), np.zeros_like(low), np.arange(len(low))
        for k, words, ones, zeros in tree.levels:
            x, y = tree._ones(words, ones, a), tree._ones(words, ones, b)
            none, some = (b - y) - (a - x), y - x
            zero, one = none > 0, some > 0
            join = lambda p, q: np.concatenate([p[zero], q[one]])
            a, b = join(a - x, zeros + x), join(b - y, zeros + y)
            symbol, smaller = join(symbol, symbol | 1 << k), join(smaller, smaller + none)
            owner = join(owner, owner)
        at, beside = self.before[symbol] + a - self.start[right][symbol], other[owner] + smaller
        return owner, symbol, (beside, at, b - a) if right else (at, beside, b - a)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and where each word begins."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return flat, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


def _pick(state, chosen):
    return tuple(part[chosen] for part in state)


class Vocabulary:
    """Sorted distinct words in a bidirectional index."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        flat, at = _points(self.words)
        self.alphabet = np.unique(flat)
        text = np.full(len(flat) + len(self.words) + 1, MARK, np.int64)
        text[np.arange(len(flat)) + np.repeat(np.arange(len(self.words)), np.diff(at)) + 1] = \
            np.searchsorted(self.alphabet, flat) + 2
        self.index = BidirectionalIndex(text, int(len(self.alphabet) + 1).bit_length())

    def _asked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words between marks: column 0 is a mark, then the word, then marks."""
        flat, at = _points(words)
        lengths = np.diff(at)
        place = np.minimum(np.searchsorted(self.alphabet, flat), max(0, len(self.alphabet) - 1))
        symbols = np.where(self.alphabet[place] == flat, place + 2, UNKNOWN) if len(self.alphabet) else flat * 0 - 1
        table = np.full((len(words), int(lengths.max(initial=0)) + 2), MARK, np.int64)
        row = np.repeat(np.arange(len(words)), lengths)
        table[row, np.arange(len(flat)) - at[row] + 1] = symbols
        return table, lengths

    def near(self, words: list[str], back: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``(number in words, number in self.words)`` at exactly one edit.

        With ``back`` false the front half (the shorter one) is matched exactly and the error
        is behind it; with ``back`` true the back half is, and words that share the front half
        too are left to the other search.  So each pair is found by one of them, once.
        """
        if not words or not self.words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        table, lengths = self._asked(words)
        half = lengths // 2
        # One half with its mark, from the middle of the word outwards.
        inner, outer = (half + 1, lengths + 1) if back else (half, half * 0)
        asks, state = self._exact(table, np.arange(len(words)), self.index.everywhere(len(words)),
                                  inner, outer, back)
        # The other half with one error, from the middle outwards the other way.
        right, step = not back, -1 if back else 1
        first, last = (half, half * 0) if back else (half + 1, lengths + 1)
        place, wrong = first[asks], []
        while len(asks):
            wanted, ended = table[asks, place], place == last[asks]
            owner, symbol, after = self.index.branches(state, right)
            other = (symbol > MARK) & (symbol != wanted[owner])
            replaced = other & ~ended[owner]
            wrong.append((asks[owner[replaced]], *_pick(after, replaced), place[owner[replaced]] + step))
            # Of a run of equal letters only the last is added or taken away.
            wrong.append((asks[owner[other]], *_pick(after, other), place[owner[other]]))
            less = ~ended
            less[less] = table[asks[less], place[less] + step] != wanted[less]
            wrong.append((asks[less], *_pick(state, less), place[less] + step))
            same = (symbol == wanted[owner]) & ~ended[owner]
            asks, state, place = asks[owner[same]], _pick(after, same), place[owner[same]] + step
        asks, low, beside, size, place = (np.concatenate(x) for x in zip(*wrong)) if wrong else [asks] * 5
        asks, state = self._exact(table, asks, (low, beside, size), place, last[asks], right)
        found = state[0] - self.index.before[MARK] - 1      # the last mark's suffix stands before all words
        if back:
            alone = np.array([not self.words[v].startswith(words[u][:len(words[u]) // 2])
                              for u, v in zip(asks.tolist(), found.tolist())], bool)
            asks, found = asks[alone], found[alone]
        return asks, found

    def _exact(self, table, asks, state, place, stop, right: bool):
        """Words whose symbols from ``place`` to ``stop`` extend their state, and the states after that."""
        step, found = 1 if right else -1, []
        while len(asks):
            state = self.index.extend(state, table[asks, place], right)
            ended = (state[2] > 0) & (place == stop)
            found.append((asks[ended], *_pick(state, ended)))
            on = (state[2] > 0) & ~ended
            asks, state, place, stop = asks[on], _pick(state, on), place[on] + step, stop[on]
        if not found:
            return asks, state
        asks, *state = (np.concatenate(x) for x in zip(*found))
        return asks, tuple(state)


# Neighbours of a whole vocabulary

NEAR = "word string, n_near long, best_n long, best string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted rows of groups: the words of an index first, then those that ask it."""
    group, words, index, counts = None, {}, None, None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "slice"))))
        asking, back = batch.column("asks").to_pylist(), batch.column("back").to_pylist()
        said, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        at = 0
        while at < len(keys):
            end = at + 1
            while end < len(keys) and (end - at + 1) * len(said[end]) <= CELLS and (
                    keys[end], asking[end], back[end]) == (keys[at], asking[at], back[at]):
                end += 1
            if keys[at] != group:
                group, words, index = keys[at], {}, None
            if not asking[at]:
                words.update(zip(said[at:end], n[at:end]))
            else:
                if index is None:
                    index = Vocabulary(list(words))
                    counts = np.array([words[w] for w in index.words], np.int64)
                who, found = index.near(said[at:end], back[at])
                if len(who):
                    by = np.lexsort((found, -counts[found], who))
                    who, found = who[by], found[by]
                    first = np.flatnonzero(np.diff(who, prepend=-1))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([said[at + u] for u in who[first].tolist()], pa.string()),
                        pa.array(np.diff(np.append(first, len(who)))), pa.array(counts[found[first]]),
                        pa.array([index.words[v] for v in found[first].tolist()], pa.string()),
                    ], ["word", "n_near", "best_n", "best"])
            at = end


def near_words(words: DataFrame, indexed: int = INDEXED, asking: int = ASKING) -> DataFrame:
    """``word, n_near, best_n, best`` of the words with a neighbour at exactly one edit.

    ``words`` holds distinct non-empty words with their count ``n`` and is read several times.
    ``best`` is the neighbour of largest ``n``, the smallest in code-point order among equals.
    """
    total = words.count()
    buckets = 1 + 8 * total // indexed
    half = lambda back, size: F.struct(
        F.lit(back).alias("back"), (F.expr(f"right(word, {size})") if back else F.expr(f"left(word, {size})")).alias("half"))
    bucket = F.pmod(F.xxhash64("key.back", "key.half"), F.lit(buckets)).alias("bucket")
    kept = words.select("word", "n", F.explode(F.array_distinct(F.array(
        *[half(False, f"cast(floor((length(word) + {d}) / 2) as int)") for d in (-1, 0, 1)],
        *[half(True, f"cast(ceil((length(word) + {d}) / 2) as int)") for d in (-1, 0, 1)]))).alias("key")) \
        .select(bucket, F.lit(False).alias("asks"), F.lit(False).alias("back"), "word", "n")
    asks = words.select("word", "n", F.explode(F.array(
        half(False, "cast(floor(length(word) / 2) as int)"),
        half(True, "cast(ceil(length(word) / 2) as int)"))).alias("key")) \
        .select(bucket, F.lit(True).alias("asks"), "key.back", "word", "n")
    rows = kept.unionByName(asks)
    sizes = rows.groupBy("bucket").agg(
        F.ceil(F.count(F.when(~F.col("asks"), 1)) / indexed).alias("parts"),
        F.ceil(F.count(F.when(F.col("asks"), 1)) / asking).alias("slices"))
    own = lambda n: F.pmod(F.xxhash64("word", "bucket"), F.col(n))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    dealt = (rows.join(sizes, "bucket").where("parts > 0 AND slices > 0")
             .withColumn("part", F.explode(F.when(F.col("asks"), every("parts")).otherwise(F.array(own("parts")))))
             .withColumn("slice", F.explode(F.when(F.col("asks"), F.array(own("slices"))).otherwise(every("slices"))))
             .select("bucket", "part", "slice", "asks", "back", "word", "n"))
    found = (dealt.repartition("bucket", "part", "slice")
             .sortWithinPartitions("bucket", "part", "slice", "asks", "back", F.length("word"))
             .mapInArrow(_search, NEAR))
    best = F.min(F.struct(-F.col("best_n"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.col1")).alias("best_n"), F.col("b.best")))


def variant_groups(words: DataFrame, ratio: int = 5, **sizes: int) -> DataFrame:
    """Every word of ``word, n`` with its spelling form and the root of its group.

    ``form``: the neighbour of largest ``n`` if that is at least ``ratio`` times the word's,
    else null, with its count ``form_n``; ``root``: the last word on the way from form to
    form (counts grow on it, so it ends), the word itself without a form; ``n_near``: the
    number of neighbours, 0 if none.  An empty table stays empty.
    """
    words = held(words, "words")
    near = near_words(words, **sizes)
    real = F.col("best_n") >= ratio * F.col("n")
    formed = held(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(real, F.col("best")).alias("form"), F.when(real, F.col("best_n")).alias("form_n")), "forms")
    ways = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:         # each round doubles the steps taken; there are log(counts) / log(ratio) at most
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = held(ways.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        ways = longer.drop("moved")
        if not longer.where("moved").head(1):
            break
    return formed.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
