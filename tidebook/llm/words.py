"""Words of whole texts as 64-bit hashes, computed for a batch of texts at a time.

Texts arrive as Arrow columns. Bytes are folded by a table of 256 entries (delimiters become
spaces, A-Z may become a-z), and the hash of a word is a polynomial of its bytes, taken from
running sums over the batch, so no Python object is made for a word. Two different words have equal
hashes with probability 2**-64 or so; everything built on these hashes is exact up to that.

Memory: a batch is cut into slices of ``SLICE_BYTES`` of text (or one text, if that is longer), and
the running sums cover ``PIECE_BYTES`` at a time (or one word, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
PIECE_BYTES = 1 << 17

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit over all output bits."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps, dtype=np.uint64)


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_UP, _DOWN = _powers(_BASE, PIECE_BYTES + 1), _powers(_INVERSE, PIECE_BYTES + 1)


def fold_table(delimiters: Iterable[int], lower: bool) -> np.ndarray:
    """Byte to byte: delimiters to 0x20; A-Z to a-z if ``lower``; the rest unchanged."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[0x41:0x5B] += 0x20
    table[np.isin(table, list(delimiters))] = 0x20
    return table


BLANKS = [0x20, *range(0x09, 0x0E)]
EXACT_WORDS = fold_table(BLANKS, lower=False)
LOWER_WORDS = fold_table(BLANKS, lower=True)
# Runs of 0-9, a-z and everything beyond ASCII.
PLAIN_WORDS = fold_table([b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)], lower=True)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than texts) and UTF-8 bytes; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    return starts - starts[0], np.frombuffer(data, np.uint8)[starts[0] : starts[-1]]


@dataclass
class Words:
    """``hashes[offsets[i]:offsets[i + 1]]`` are the words of text i, in order; ``starts`` and
    ``ends`` are their places in ``data``."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.offsets[i] : self.offsets[i + 1]]

    def text(self, i: int) -> np.ndarray:
        """For each word, the text it belongs to is found from these offsets."""
        return np.repeat(np.arange(len(self)), np.diff(self.offsets))


def words_of(column: pa.Array, table: np.ndarray) -> Words:
    """Words of every text of an Arrow column of strings."""
    offsets, data = text_buffers(column)
    n = len(data)
    is_word = table[data] != 0x20
    edges = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    before[edges] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE_BYTES, side="right")))
        size = ends[j - 1] - base
        up, down = (_UP, _DOWN) if size <= PIECE_BYTES else (_powers(_BASE, size), _powers(_INVERSE, size))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_LETTER[table[data[base : base + size]]] * up[:size], out=sums[1:])
        hashes[i:j] = (sums[ends[i:j] - base] - sums[starts[i:j] - base]) * down[starts[i:j] - base]
        i = j
    return Words(mix(hashes), np.searchsorted(starts, offsets), starts, ends, data)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n consecutive words (none if there are fewer words)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(m, np.uint64)
    step = max(PIECE_BYTES - n, 1)
    up, down = (_UP, _DOWN) if n < PIECE_BYTES else (_powers(_BASE, n + step), _powers(_INVERSE, n + step))
    for i in range(0, m, step):
        part = hashes[i : i + step + n - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        count = len(part) - n + 1
        out[i : i + count] = (sums[n:] - sums[:-n]) * down[:count]
    return mix(out)


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``SLICE_BYTES`` of text, or of one row if that is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        i = 0
        while i < len(sizes):
            limit = (ends[i - 1] if i else 0) + SLICE_BYTES
            j = max(i + 1, int(np.searchsorted(ends, limit, side="right")))
            yield batch.slice(i, j - i)
            i = j
