"""Words and their hashes for many texts at once, on UTF-8 bytes with numpy.

A text is never turned into a list of Python strings: separators are found with a
byte table, and a word's 64-bit hash is mixed from its bytes, eight at a time.  Hashes
of runs of words (or of a few characters) are differences of prefix sums.  All three
alphabets below split at ASCII bytes only, so no code point is ever cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on together; one longer text goes alone.
CHUNK_BYTES = 2 << 20

SPACES = np.zeros(256, dtype=bool)          # [\x20\x09-\x0D]
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)       # ASCII but for 0-9 A-Z a-z
NOT_ALNUM[:0x80] = True
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    NOT_ALNUM[_low:_high] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit of a uint64 array over all bits."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 7)
_LOWER_VALUES = _BYTE_VALUES[LOWER]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


#: Longer words are hashed one by one, by a library's cryptographic function.
LONG_WORD = 256
_TAILS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts:ends]``: every eight bytes are mixed into the state.

    No linear function of the bytes: words built to meet under a polynomial hash differ.
    """
    size = ends - starts
    hashes = mix(size.astype(np.uint64), 3)
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    at = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    for offset in range(0, LONG_WORD, 8):
        at = at[size[at] > offset]
        if not len(at):
            break
        chunk = eight[starts[at] + offset].view(np.uint64).ravel() & _TAILS[np.minimum(size[at] - offset, 8)]
        hashes[at] = mix(hashes[at] ^ chunk, 4)
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest()
        hashes[k] = np.uint64(int.from_bytes(digest, "little"))
    return hashes


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums ``values[i] * base**i`` before each position, modulo 2**64."""
    up, _ = _power_tables(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]``, alike wherever the same values stand."""
    _, down = _power_tables(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


@dataclass
class Words:
    """Words of a chunk of texts; ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray        # uint8
    starts: np.ndarray      # byte offsets
    ends: np.ndarray
    first: np.ndarray
    base: np.ndarray        # byte offset of each text, and the end
    hashes: np.ndarray      # uint64 of each word

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start (word number) and hash of each run of ``size`` words inside one text."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        counts = np.diff(self.first)
        fits = np.repeat(self.first[1:], counts) - np.arange(n) >= size
        start = np.flatnonzero(fits)
        return start, span_hash(prefix_hash(self.hashes), start, start + size)


def split_words(data: np.ndarray, base: np.ndarray, separators: np.ndarray,
                lower: bool) -> Words:
    """Cut concatenated texts (``data[base[d]:base[d + 1]]`` is text ``d``) into words."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(separators[data], out=inside[1:-1])
    edge = inside[1:] != inside[:-1]
    # Words of two neighbouring texts must not grow together.
    inner = base[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(data))])
    touching = inner[inside[inner] & inside[inner + 1]]
    at = np.flatnonzero(edge)
    if len(touching):
        at = np.sort(np.concatenate([at, touching, touching]))
    starts, ends = at[0::2], at[1::2]
    first = np.searchsorted(starts, base)
    return Words(data, starts, ends, first, base, word_hashes(LOWER[data] if lower else data, starts, ends))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of texts of about ``limit`` bytes."""
    data, base = text_buffers(column)
    row, n = 0, len(base) - 1
    while row < n:
        end = int(np.searchsorted(base, base[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[base[row]:base[end]], base[row:end + 1] - base[row]
        row = end
