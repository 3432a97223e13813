"""Bloom filters over 64-bit hashes, built by Spark and broadcast; their size is bounded.

A full filter lets more through; whatever follows it must not depend on it for exactness.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, longs, map_batches, run_starts
from tidebook.llm.words import mix

MOST_BITS = 1 << 27
BITS_EACH = 16
PROBES = 3


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(hashes + np.uint64(i + 1)) & np.uint64(bits - 1) for i in range(PROBES)]


def _words(batches: Batches, bits: int) -> Batches:
    """The 64-bit words of the filter that these hashes set, combined within each batch."""
    for rows in batches:
        at = np.unique(np.concatenate(_places(rows.column(0).to_numpy().view(np.uint64), bits)))
        place, mask = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
        runs = run_starts(place)
        yield batch(place=longs(place[runs]), mask=longs(np.bitwise_or.reduceat(mask, runs) if len(runs) else mask))


def bloom_filter(hashes: DataFrame, n: int, most_bits: int = MOST_BITS) -> np.ndarray:
    """A filter of the one long column of ``hashes``, which has about n rows: 16 bits for each, in
    a power of two, up to ``most_bits`` (16 MB)."""
    bits = min(most_bits, 1 << max(16, math.ceil(math.log2(BITS_EACH * n + 1))))
    masks = map_batches(hashes, partial(_words, bits=bits), "place long, mask long")
    rows = masks.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows.column("place").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return out


def passes(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter; the few that pass a probe go on to the next."""
    keep = np.arange(len(hashes))
    for i in range(PROBES):
        at = mix(hashes[keep] + np.uint64(i + 1)) & np.uint64(len(found) * 64 - 1)
        keep = keep[(found[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
    out = np.zeros(len(hashes), bool)
    out[keep] = True
    return out
