"""A Bloom filter of bounded size over a column of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

#: Sixteen bits for each key, but never more than this (16 MB): beyond it more keys pass
#: that are not in the set, which costs work and never a result.
MAX_BITS = 1 << 27
PROBES = 3


def _bits(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(keys, 20 + k) & np.uint64(bits - 1) for k in range(PROBES)]


def _words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(_bits(keys, bits)))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            value = np.uint64(1) << (at & np.uint64(63))
            value = np.bitwise_or.reduceat(value, first) if len(first) else value
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))],
                ["word", "value"])
    return run


def build(keys: DataFrame, max_bits: int = MAX_BITS) -> np.ndarray:
    """The filter of a one-column table of non-null longs, as uint64 words."""
    bits, wanted = 1 << 10, min(16 * keys.count(), max_bits)
    while bits < wanted:
        bits <<= 1
    out = np.zeros(bits // 64, np.uint64)
    got = (keys.mapInArrow(_words(bits), "word long, value long")
           .groupBy("word").agg(F.bit_or("value").alias("value")).toArrow())
    out[got.column("word").to_numpy()] = got.column("value").to_numpy().view(np.uint64)
    return out


def passes(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    hit = np.ones(len(keys), bool)
    for at in _bits(keys, 64 * len(bitmap)):
        hit &= (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) > 0
    return hit
