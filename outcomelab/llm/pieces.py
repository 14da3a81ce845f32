"""SentencePiece encoding and decoding for merge-type (BPE) models, exact and without a queue of merges.

A sequence of pieces is the encoding of a text if and only if every two neighbours are
*compatible*: merging their characters anew, best score first and leftmost among equals,
gives the same two pieces back.  Encoding therefore never replays the merges of a whole
text.  An Aho-Corasick automaton tells the longest piece at every place; the encoder takes
it if it is compatible with the piece before, tries its shorter prefixes if not, and steps
back if none fits.  A place from which no piece fits never lies on the encoding, so a bit
per place remembers it and no place fails twice.

Where no piece of the model holds a space mark behind another character, no merge crosses
from a word to the next space mark; texts are cut there and frequent words are encoded once.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import chunks

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Entries after which a task forgets the words or the compatible pairs it has seen.
REMEMBERED = 1 << 19
LONGEST_REMEMBERED = 48

codecs.register_error("per_byte", lambda e: ("�", e.start + 1))


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of the fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, message[at:at + size]
            at += size


class PieceModel:
    """Pieces, scores and switches of a SentencePiece model file of the merge type.

    Models that rewrite texts before merging (character maps, removed spaces), that lack
    byte pieces or that hold user-defined or unused pieces are refused.
    """

    def __init__(self, model: bytes):
        fields = list(_fields(model))
        trainer = dict(_fields(next((v for f, v in fields if f == 2), b"")))
        normalizer = dict(_fields(next((v for f, v in fields if f == 3), b"")))
        if trainer.get(3, 1) != 2:
            raise ValueError("not a model of the merge (BPE) type")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24):
            raise ValueError("the model rewrites texts before it merges")
        if not trainer.get(35):
            raise ValueError("the model has no byte pieces")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.bos, self.eos = trainer.get(41, 1), trainer.get(42, 2)
        unknown = trainer.get(44, b" \xe2\x81\x87 ").decode()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.surface: list[str] = []
        self.byte_ids = [0] * 256
        values = []
        for n, piece in enumerate(dict(_fields(v)) for f, v in fields if f == 1):
            text, kind = piece.get(1, b"").decode(), piece.get(3, NORMAL)
            values.append(-1)
            if kind == BYTE:
                values[-1] = int(text[1:-1], 16)
                self.byte_ids[values[-1]] = n
            elif kind == NORMAL:
                self.ids[text] = n
                self.scores[text] = struct.unpack("<f", piece.get(2, bytes(4)))[0]
            elif kind not in (UNKNOWN, CONTROL):
                raise ValueError("user-defined and unused pieces are not supported")
            self.surface.append({NORMAL: text.replace(SPACE, " "), UNKNOWN: unknown}.get(kind, ""))
        self.byte_values = np.array(values, np.int64)
        self.strips = {n for p, n in self.ids.items() if p.startswith(SPACE)} if self.dummy_prefix else set()
        self.packed_ids = {p: struct.pack("<I", n) for p, n in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        whole = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.runs = re.compile(".+" if whole else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)
        self._fits: dict[tuple[str | None, str], bool] = {}
        self._shorter: dict[str, int] = {}
        self._words: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The merges replayed on a short text: best score first, leftmost among equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, last: str | None, piece: str) -> bool:
        """Whether ``piece`` can follow ``last`` (or begin a text); the answer is remembered."""
        if len(self._fits) >= REMEMBERED:
            self._fits.clear()
        known = self.merged((last or "") + piece) == ([piece] if last is None else [last, piece])
        self._fits[last, piece] = known
        return known

    def shorter(self, piece: str) -> int:
        """Length of the longest piece that is a proper prefix; a character alone always counts."""
        if len(self._shorter) >= REMEMBERED:
            self._shorter.clear()
        size = next((n for n in range(len(piece) - 1, 1, -1) if piece[:n] in self.ids), min(1, len(piece) - 1))
        self._shorter[piece] = size
        return size

    def split(self, run: str) -> list[str]:
        """The pieces of ``run``; characters that no piece has stand alone."""
        n = len(run)
        longest = array("i", [1]) * n
        for end, size in self.automaton.iter(run):      # ends ascend: the last write is the longest
            longest[end - size + 1] = size
        failed = bytearray((n >> 3) + 1)
        fits, shorter = self._fits.get, self._shorter.get
        parts: list[str] = []
        last, at, size = None, 0, longest[0] if n else 0
        while at < n:
            while size:
                end = at + size
                piece = run[at:end]
                if not failed[end >> 3] >> (end & 7) & 1:
                    good = fits((last, piece))
                    if self.fits(last, piece) if good is None else good:
                        break
                size = shorter(piece)
                if size is None:
                    size = self.shorter(piece)
            if size:
                parts.append(piece)
                last, at = piece, end
                size = longest[at] if at < n else 0
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = parts.pop()
                at -= len(piece)
                size = self.shorter(piece)
                last = parts[-1] if parts else None
        return parts

    def _as_bytes(self, character: str) -> bytes:
        return struct.pack(f"<{len(character.encode())}I", *[self.byte_ids[b] for b in character.encode()])

    def _packed(self, run: str) -> bytes:
        known = self._words.get(run)
        if known is None:
            number = self.packed_ids.get
            known = b"".join([number(p) or self._as_bytes(p) for p in self.split(run)])
            if len(run) <= LONGEST_REMEMBERED:
                if len(self._words) >= REMEMBERED:
                    self._words.clear()
                self._words[run] = known
        return known

    def encode(self, text: str, ends: bool = True) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with begin and end ids if ``ends``."""
        if text:
            text = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        body = b"".join(map(self._packed, self.runs.findall(text)))
        return struct.pack("<I", self.bos) + body + struct.pack("<I", self.eos) if ends else body

    def decode(self, packed: bytes) -> str:
        """The text of packed ids: controls vanish, the added space goes, a bad byte becomes U+FFFD."""
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        if len(ids) and ids.max() >= len(self.surface):
            raise ValueError(f"id {ids.max()} is not in the model")
        values = self.byte_values[ids]
        edges = np.flatnonzero(np.diff(values >= 0)) + 1
        out: list[str] = []
        head = True                 # the space mark of the first piece is still to go
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
            if low == high:
                continue
            if values[low] >= 0:
                out.append(values[low:high].astype(np.uint8).tobytes().decode("utf-8", "per_byte"))
                head = False
                continue
            part = ids[low:high].tolist()
            while head and part:
                n = part.pop(0)
                said = self.surface[n]
                head = not said
                out.append(said[1:] if n in self.strips else said)
            out.append("".join(map(self.surface.__getitem__, part)))
        return "".join(out)


_models: dict[int, PieceModel] = {}


def _model(shared) -> PieceModel:
    """The model of a broadcast, parsed once a worker."""
    if shared.id not in _models:
        _models.clear()
        _models[shared.id] = PieceModel(shared.value)
    return _models[shared.id]


class _Shared:
    """A broadcast with a key of its own."""

    def __init__(self, df: DataFrame, model: bytes):
        PieceModel(model)           # refuse what cannot be encoded before any task starts
        self.id = hash(model)
        self.sent = df.sparkSession.sparkContext.broadcast(model)

    @property
    def value(self) -> bytes:
        return self.sent.value


def read_model(path: str) -> bytes:
    """A model file of this machine; it travels to the tasks as a broadcast of its few hundred KB."""
    with open(path, "rb") as file:
        return file.read()


def _mapped(df: DataFrame, column: str, out: str, kind: str, call, keep: bool) -> DataFrame:
    own = [c for c in df.columns if c != column]
    names = {c: f"{c}_in" if c == out else c for c in own}
    held = "__piece_input"
    df = df.select(*[F.col(f"`{c}`").alias(names[c]) for c in own], F.col(f"`{column}`").alias(held))
    kept = [f for f in df.schema if keep or f.name != held]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out}` {kind}"])
    found = df.mapInArrow(call(len(df.columns) - 1, len(kept)), schema)
    return found.withColumnRenamed(held, column)


def encode(docs: DataFrame, model: bytes, text: str = "text", out: str = "ids",
           ends: bool = True, keep_text: bool = True) -> DataFrame:
    """All rows of ``docs`` with their ids appended as ``out`` (binary, little-endian unsigned 32-bit).

    Whole texts are encoded.  A null text counts as empty, and an empty text has the begin
    and end ids only (none without ``ends``).  Repeated rows each get their ids; a column
    of ``docs`` named like ``out`` is kept as ``<out>_in``; an empty table stays empty.
    """
    shared = _Shared(docs, model)

    def call(at: int, kept: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _model(shared)
            for batch in batches:
                for low, high, data, base in chunks(batch.column(at)):
                    ids = [found.encode(data[base[k]:base[k + 1]].tobytes().decode(), ends)
                           for k in range(high - low)]
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).slice(low, high - low) for c in range(kept)], pa.array(ids, pa.binary())],
                        [*batch.schema.names[:kept], out])
        return run

    return _mapped(docs, text, out, "binary", call, keep_text)


def decode(df: DataFrame, model: bytes, ids: str = "ids", out: str = "decoded",
           keep_ids: bool = True) -> DataFrame:
    """All rows of ``df`` with the text of their packed ids appended as ``out``.

    Null ids have a null text, no ids the empty one; ids beyond the model are an error.
    A column of ``df`` named like ``out`` is kept as ``<out>_in``.
    """
    shared = _Shared(df, model)

    def call(at: int, kept: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _model(shared)
            for batch in batches:
                packed = batch.column(at)
                size = max(1, (2 << 20) * len(packed) // max(1, packed.nbytes))
                for low in range(0, len(packed), size):
                    part = batch.slice(low, size)
                    texts = [None if x is None else found.decode(x) for x in part.column(at).to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:kept], pa.array(texts, pa.string())], [*batch.schema.names[:kept], out])
        return run

    return _mapped(df, ids, out, "string", call, keep_ids)
