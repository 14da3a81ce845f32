"""Edit-aware token counts: a segment tree of pre-tokens per document.

A byte-level BPE tokenizer first cuts a text into pre-tokens by a pattern and encodes each
on its own, so a text's count is the sum over its pre-tokens.  ``CountTree`` keeps, over
slots of ``SLOT`` pre-tokens, the characters and tokens of every subtree.

An edit re-encodes only the pre-tokens that it touches and those whose match could see it:
the pattern looks at most one character past a match, so matches that end two characters
before an edit stand.  Matching goes on behind the edit until a new boundary falls on an
old one; from there on everything is as before.  Edits that are close to each other are
worked off together.  Then the sums on the paths from the touched slots are updated.

The vocabulary is a file of ranks (its path is a parameter, nothing is trained); it is
read on the driver, checked against ``MAX_RANK_BYTES`` and broadcast.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pre-token pattern of the vocabulary: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PATTERN = regex.compile(PATTERN)
#: A match depends on no character after its end but this many.
SIGHT = 1
SLOT = 64
MAX_RANK_BYTES = 64 << 20
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 400_000

Edit = tuple[int, int, str]


def load_ranks(path: str) -> dict[bytes, int]:
    """Token ranks from a file of ``base64-token rank`` lines."""
    if os.path.getsize(path) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Counter(dict):
    """Tokens of a pre-token; remembers what it has counted."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) <= 64:
            self[piece] = n
        return n

    def pieces(self, texts: list[str]) -> list[int]:
        return [self[p] for p in texts]


class CountTree:
    """Sums of characters and tokens over the pre-tokens of one text."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self._fill([(lengths[i:i + SLOT], counts[i:i + SLOT]) for i in range(0, len(lengths), SLOT)])

    @classmethod
    def of(cls, text: str, counter: Counter) -> CountTree:
        pieces = _PATTERN.findall(text)
        return cls(list(map(len, pieces)), counter.pieces(pieces))

    def _fill(self, slots: list[tuple[list[int], list[int]]]) -> None:
        self.slots = slots
        self.width = 1 << max(0, len(slots) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width:self.width + len(slots)] = [(sum(a), sum(b)) for a, b in slots] or np.zeros((0, 2))
        for level in range(self.width - 1, 0, -1):
            self.sums[level] = self.sums[2 * level] + self.sums[2 * level + 1]

    def to_bytes(self) -> bytes:
        """Slot sizes, lengths and counts; the sums are made anew on reading."""
        sizes = [len(a) for a, _ in self.slots]
        flat = [len(sizes), *sizes, *(x for a, _ in self.slots for x in a), *(x for _, b in self.slots for x in b)]
        return np.array(flat, np.uint32).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountTree:
        flat = np.frombuffer(raw, np.uint32)
        sizes = flat[1:1 + int(flat[0])].astype(np.int64)
        ends = np.cumsum(sizes).tolist()
        rest = flat[1 + len(sizes):].tolist()
        n = ends[-1] if ends else 0
        tree = cls([], [])
        tree._fill([(rest[end - size:end], rest[n + end - size:n + end]) for size, end in zip(sizes.tolist(), ends)])
        return tree

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def size(self) -> int:
        return sum(len(a) for a, _ in self.slots)

    def _find(self, offset: int) -> tuple[int, int]:
        """The slot that holds a character, and where the slot starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if offset >= start + self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.width, start

    def boundary_before(self, offset: int) -> int:
        """The last pre-token boundary at or before ``offset``."""
        if offset <= 0 or not self.slots:
            return 0
        if offset >= self.chars:
            return self.chars
        slot, at = self._find(offset)
        for n in self.slots[slot][0]:
            if at + n > offset:
                break
            at += n
        return at

    def replace(self, start: int, end: int, lengths: list[int], counts: list[int]) -> None:
        """Put new pre-tokens in the place of those between two boundaries."""
        if not self.slots:
            self._fill([(lengths, counts)] if lengths else [])
            return
        last = len(self.slots) - 1
        first, at = (last, self.chars - int(self.sums[self.width + last, 0])) if start >= self.chars else (
            self._find(start))
        slot = first
        while True:
            old, old_counts = self.slots[slot]
            head = tail = 0
            position = at
            while head < len(old) and position < start:
                position += old[head]
                head += 1
            tail = head
            while tail < len(old) and position < end:
                position += old[tail]
                tail += 1
            at += int(self.sums[self.width + slot, 0])
            put = (lengths, counts) if slot == first else ([], [])
            self.slots[slot] = (old[:head] + put[0] + old[tail:], old_counts[:head] + put[1] + old_counts[tail:])
            self._update(slot)
            slot += 1
            if at >= end or slot > last:
                break
        if len(self.slots[first][0]) > 4 * SLOT:      # cut a slot that has grown: sums only
            flat = [x for a, _ in self.slots for x in a], [x for _, b in self.slots for x in b]
            self.__init__(*flat)

    def _update(self, slot: int) -> None:
        node = self.width + slot
        self.sums[node] = sum(self.slots[slot][0]), sum(self.slots[slot][1])
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, text: str, edits: list[Edit], counter: Counter) -> tuple[str, int]:
        """Apply edits ``(start, end, replacement)`` of ``text``; the new text and how many pre-tokens were encoded.

        Edits are in order and do not overlap.
        """
        parts, at = [], 0
        for start, end, new in edits:
            parts += [text[at:start], new]
            at = end
        changed = "".join(parts) + text[at:]
        encoded, j = 0, 0
        shift = 0           # of the edits that are done, and so of the tree's offsets
        while j < len(edits):
            begin = self.boundary_before(edits[j][0] + shift - SIGHT - 1)
            behind = shift + len(edits[j][2]) - (edits[j][1] - edits[j][0])
            pieces, position = [], begin
            stop = None
            matches = _PATTERN.finditer(changed, begin)
            while stop is None:
                old = position - behind + shift      # where this stands in the tree
                done = position >= edits[j][1] + behind
                if done and j + 1 < len(edits) and old > edits[j + 1][0] + shift - SIGHT - 1:
                    j += 1
                    behind += len(edits[j][2]) - (edits[j][1] - edits[j][0])
                elif done and self.boundary_before(old) == old:
                    stop = old
                else:
                    m = next(matches, None)
                    if m is None:
                        stop = self.chars
                    else:
                        pieces.append(m[0])
                        position = m.end()
            self.replace(begin, stop, list(map(len, pieces)), counter.pieces(pieces))
            encoded += len(pieces)
            shift = behind
            j += 1
        return changed, encoded


_CONTACTS = regex.compile(
    # A name is tried where its run begins, or where the search for the next contact does.
    r"(?P<mail>(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,})|(?P<phone>\+?\d[\d ().-]{6,}\d)")


def contact_edits(text: str) -> list[Edit]:
    """Edits that put a mark in the place of each e-mail address and telephone number."""
    return [(*m.span(), f"[{m.lastgroup}]") for m in _CONTACTS.finditer(text)]


_counters: dict[int, Counter] = {}


def _count(shared, rule: Callable[[str], list[Edit]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared)
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(6)]
            given = batch.column(2) if batch.num_columns > 2 else None
            for r, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                tree = CountTree.of(text, counter)
                if given is not None:
                    edits = [(e["start"], e["end"], e["text"] or "") for e in given[r].as_py() or ()]
                    edits = clean_edits(edits, len(text))
                else:
                    edits = rule(text) if rule else []
                row = [tree.size, tree.tokens, len(edits)]
                _, encoded = tree.edit(text, edits, counter) if edits else (text, 0)
                for column, x in zip(out, [*row, encoded, tree.size, tree.tokens]):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in out]], ["doc_id", *FIELDS])
    return run


def _counter(shared) -> Counter:
    """One counter per worker and vocabulary."""
    if id(shared.value) not in _counters:
        _counters.clear()
        _counters[id(shared.value)] = Counter(shared.value)
    return _counters[id(shared.value)]


def _trees(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared)
        for batch in batches:
            trees = [CountTree.of(t or "", counter) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.tokens for t in trees], pa.int64()),
                 pa.array([t.to_bytes() for t in trees], pa.binary())], ["doc_id", "n_tokens", "tree"])
    return run


def count_trees(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, tree`` of every row: what is kept until its edits come."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))   # MAX_RANK_BYTES at most
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_trees(shared), f"doc_id {kind}, n_tokens long, tree binary")


def _updates(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, raw, edits in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                tree, text = CountTree.from_bytes(raw), text or ""
                edits = clean_edits([(e["start"], e["end"], e["text"] or "") for e in edits or ()], len(text))
                text, encoded = tree.edit(text, edits, counter) if edits else (text, 0)
                for column, x in zip(out, (text, tree.tokens, tree.to_bytes(), encoded)):
                    column.append(x)
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, k) for x, k in zip(out, kinds)]],
                ["doc_id", "text", "n_tokens", "tree", "n_encoded"])
    return run


def update_trees(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text",
                 tree: str = "tree", edits: str = "edits") -> DataFrame:
    """``doc_id, text, n_tokens, tree, n_encoded`` after the edits of rows that carry their kept tree.

    A tree must be that of the row's text.  Null edits are none; edits as in ``edited_counts``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))   # MAX_RANK_BYTES at most
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(tree).alias("tree"),
                       F.col(edits).alias("edits"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_updates(shared), f"doc_id {kind}, text string, n_tokens long, tree binary, n_encoded long")


FIELDS = ("n_pretokens", "n_tokens", "n_edits", "n_encoded", "n_pretokens_after", "n_tokens_after")


def clean_edits(edits: list[Edit], size: int) -> list[Edit]:
    """In order, inside the text, without overlap: of overlapping edits the first stays."""
    out: list[Edit] = []
    for start, end, new in sorted(edits):
        start, end = max(0, min(start, size)), max(0, min(end, size))
        if start <= end and (not out or start >= out[-1][1]):
            out.append((start, end, new))
    return out


def edited_counts(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text",
                  edits: str | None = None, rule: Callable[[str], list[Edit]] | None = None) -> DataFrame:
    """Counts of every row before and after its edits, and how many pre-tokens the edits encoded.

    ``edits`` names a column ``array<struct<start:int,end:int,text:string>>`` in code points;
    else ``rule`` makes the edits of a text.  Null and empty texts have no pre-tokens (and can
    be edited); null edits are none.  Repeated rows each get their result; rows are worked
    off where they are read.  Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))   # MAX_RANK_BYTES at most
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    if edits:
        columns.append(F.col(edits).alias("edits"))
    rows = docs.select(*columns)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_count(shared, rule), f"doc_id {kind}, " + ", ".join(f"{f} long" for f in FIELDS))
