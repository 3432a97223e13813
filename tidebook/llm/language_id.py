"""Language ID by prediction by partial matching (PPM) over bytes.

Every language has a context tree of order 3: counts of each byte after the three bytes before it,
and after the last two, one and none. A byte seen after its context costs the logarithm of its
share; else an escape is paid and the next shorter context is asked, down to equal shares of 256
bytes. Statistics are frozen after training, so the cost of a byte is a function of its last four
bytes, and a text's code length in every language is a sum of table entries.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, longs, map_batches
from tidebook.llm.words import fold_table, slices, text_buffers

ORDER = 3
# The training sample: per language at most so many documents, and of each at most so many
# characters (32 KB), from a place that a hash tells.
SAMPLE_DOCUMENTS = 1000
SAMPLE_CHARACTERS = 8192
DRAWN = 4
UNKNOWN = "und"
PIECE = 1 << 16
# A text that no language codes in less than its own bytes is in none of them.
RAW_BITS = 8.0

_LOWER = fold_table([], lower=True)


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, each after three blanks, and where each text begins."""
    offsets, data = text_buffers(column)
    sizes = np.diff(offsets)
    starts = offsets[:-1] + ORDER * np.arange(1, len(sizes) + 1)
    out = np.full(len(data) + ORDER * len(sizes), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(starts - offsets[:-1], sizes)] = _LOWER[data]
    return out, starts


def _codes(padded: np.ndarray, a: int, b: int) -> np.ndarray:
    """Bytes a to b with their contexts, as numbers of four bytes, the newest lowest."""
    wide = padded[a - ORDER : b].astype(np.uint32)
    return (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]


def _grams(batches: Batches) -> Batches:
    for rows in slices(batches, "text"):
        langs = np.array(rows.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            padded, starts = _padded(rows.column("text").filter(pa.array(langs == lang)))
            ends = np.concatenate([starts[1:] - ORDER, [len(padded)]])
            codes = [_codes(padded, a, b) for a, b in zip(starts, ends) if b > a]
            found, times = np.unique(np.concatenate(codes) if codes else np.empty(0, np.uint32), return_counts=True)
            yield batch(lang=pa.array([lang] * len(found), pa.string()), code=longs(found), n=longs(times))


def training_sample(docs: DataFrame) -> DataFrame:
    """(lang, text) of up to ``SAMPLE_DOCUMENTS`` documents per language, by the hash of their ids.

    Documents of any length are drawn; of one longer than ``SAMPLE_CHARACTERS`` a piece is learned
    from, so the sample's bytes are bounded for each language. Documents whose crc32 of the id as
    text leaves 1 by 3, and those without an id, a language or a text, are not learned from.
    """
    usable = docs.filter(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    )
    # A draw that leaves a few times as many as wanted, so that no task ranks a whole language.
    drawn = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("draw"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"))
    share = (F.col("draw").cast("double") + 2.0**63) / 2.0**64
    ids = drawn.join(F.broadcast(sizes), "lang").filter(share * F.col("n") < DRAWN * SAMPLE_DOCUMENTS).withColumn(
        "place", F.row_number().over(W.partitionBy("lang").orderBy("draw", "doc_id"))
    )
    chosen = F.broadcast(ids.filter(F.col("place") <= SAMPLE_DOCUMENTS).select("doc_id", "lang").distinct())
    sampled = usable.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi")
    spare = F.greatest(F.length("text") - SAMPLE_CHARACTERS, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("doc_id", F.length("text")), spare).cast("int") + 1
    return sampled.select("lang", F.col("text").substr(start, F.lit(SAMPLE_CHARACTERS)).alias("text"))


@dataclass
class Model:
    """Costs in bits, a column per language: of whole codes, of codes of three bytes, and dense for
    shorter ones; escapes from contexts of three bytes and of two."""

    languages: list[str]
    codes: np.ndarray
    costs: np.ndarray
    codes2: np.ndarray
    costs2: np.ndarray
    costs1: np.ndarray
    contexts3: np.ndarray
    escapes3: np.ndarray
    escapes2: np.ndarray
    slots: tuple[np.ndarray, np.ndarray, int] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.slots = _hash_slots(self.codes)


def _hash_slots(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Open addressing: the row + 1 of the code at its slot or a few slots later; most steps."""
    bits = max(8, int(4 * len(codes) + 1).bit_length())
    rows, keys = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.uint32)
    left, step = np.arange(len(codes)), 0
    while len(left):
        at = (_slot(codes[left], bits) + step) & ((1 << bits) - 1)
        free = rows[at] == 0
        rows[at[free]] = left[free] + 1
        keys[at[free]] = codes[left[free]]
        left, step = left[rows[at] != left + 1], step + 1
    return rows, keys, step


def _slot(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)


def _level(codes: np.ndarray, lang: np.ndarray, n: np.ndarray, n_langs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one order: codes and their costs (infinite where unseen), contexts and their escapes."""
    rows, place = np.unique(codes, return_inverse=True)
    counts = np.zeros((len(rows), n_langs))
    np.add.at(counts, (place, lang), n)
    contexts, owner = np.unique(rows >> 8, return_inverse=True)
    totals, kinds = np.zeros((2, len(contexts), n_langs))
    np.add.at(totals, owner, counts)
    np.add.at(kinds, owner, counts > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        costs = np.log2(totals[owner] + kinds[owner]) - np.log2(counts)
        escapes = np.where(kinds > 0, np.log2(totals + kinds) - np.log2(kinds), 0.0)
    return rows, costs, contexts, escapes


def build(languages: list[str], lang: np.ndarray, codes: np.ndarray, n: np.ndarray) -> Model:
    """Frozen statistics from counts of four-byte codes; shorter contexts are sums over them."""
    k = len(languages)
    codes = codes.astype(np.uint64)

    def filled(costs: np.ndarray, escape: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        return np.where(np.isfinite(costs), costs, escape + shorter)

    rows, costs, _, escapes = _level(codes & np.uint64(0xFF), lang, n, k)
    costs0 = np.tile(8.0 + (escapes[0] if len(escapes) else np.zeros(k)), (256, 1))
    costs0[rows.astype(np.int64)] = filled(costs, escapes[0] if len(escapes) else 0, np.full((len(rows), k), 8.0))

    rows, costs, contexts, escapes = _level(codes & np.uint64(0xFFFF), lang, n, k)
    dense = np.zeros((256, k))
    dense[contexts.astype(np.int64)] = escapes
    costs1 = np.repeat(dense, 256, axis=0) + np.tile(costs0, (256, 1))
    costs1[rows.astype(np.int64)] = filled(costs, dense[(rows >> np.uint64(8)).astype(np.int64)], costs0[(rows & np.uint64(0xFF)).astype(np.int64)])

    codes2, costs, contexts, escapes = _level(codes & np.uint64(0xFFFFFF), lang, n, k)
    escapes2 = np.zeros((1 << 16, k))
    escapes2[contexts.astype(np.int64)] = escapes
    costs2 = filled(costs, escapes2[(codes2 >> np.uint64(8)).astype(np.int64)], costs1[(codes2 & np.uint64(0xFFFF)).astype(np.int64)])

    codes3, costs, contexts3, escapes3 = _level(codes, lang, n, k)
    own = np.searchsorted(contexts3, codes3 >> np.uint64(8))
    shorter = costs2[np.searchsorted(codes2, codes3 & np.uint64(0xFFFFFF))]
    costs3 = filled(costs, escapes3[own], shorter)
    small = [a.astype(np.float32) for a in (costs3, costs2, costs1, escapes3, escapes2)]
    return Model(
        languages, codes3.astype(np.uint32), small[0], codes2.astype(np.uint32), small[1], small[2],
        contexts3.astype(np.uint32), small[3], small[4],
    )


def fit(docs: DataFrame) -> Model:
    """Counts of the training sample, summed by Spark; a few hundred thousand rows."""
    counts = map_batches(training_sample(docs), _grams, "lang string, code long, n long")
    rows = counts.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(rows.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(names))
    lang = np.searchsorted(languages, names) if languages else np.empty(0, np.int64)
    return build(languages, lang, rows.column("code").to_numpy(), rows.column("n").to_numpy())


def _among(found: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted code is, and whether it is there."""
    if not len(found):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
    return at, found[at] == wanted


def costs_of(model: Model, codes: np.ndarray) -> np.ndarray:
    """Bits of every byte in every language."""
    rows, keys, steps = model.slots
    bits = len(rows).bit_length() - 1
    at = _slot(codes, bits)
    row = np.where((keys[at] == codes) & (rows[at] > 0), rows[at], 0)
    left = np.flatnonzero((row == 0) & (rows[at] > 0))
    for step in range(1, steps):
        if not len(left):
            break
        at = (_slot(codes[left], bits) + step) & (len(rows) - 1)
        hit = (keys[at] == codes[left]) & (rows[at] > 0)
        row[left[hit]] = rows[at[hit]]
        left = left[~hit & (rows[at] > 0)]
    out = np.empty((len(codes), len(model.languages)), np.float32)
    known = row > 0
    out[known] = model.costs[row[known] - 1]
    rest = np.flatnonzero(~known)
    if len(rest):
        code = codes[rest]
        at, there = _among(model.contexts3, code >> 8)
        escape = np.where(there[:, None], model.escapes3[at] if len(model.escapes3) else 0, 0)
        short = code & np.uint32(0xFFFFFF)
        at, there = _among(model.codes2, short)
        lower = model.escapes2[short >> 8] + model.costs1[short & np.uint32(0xFFFF)]
        lower[there] = model.costs2[at[there]]
        out[rest] = escape + lower
    return out


def code_lengths(model: Model, column: pa.Array) -> np.ndarray:
    """Bits of every text in every language, whole texts, piece by piece."""
    padded, starts = _padded(column)
    ends = np.concatenate([starts[1:] - ORDER, [len(padded)]]) if len(starts) else starts
    totals = np.zeros((len(starts), len(model.languages)))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, side="right")))
        if j == i + 1:
            for a in range(starts[i], ends[i], PIECE):
                totals[i] += costs_of(model, _codes(padded, a, min(a + PIECE, ends[i]))).sum(axis=0, dtype=np.float64)
        else:
            costs = costs_of(model, _codes(padded, starts[i], ends[j - 1]))
            sums = np.concatenate([np.zeros((1, costs.shape[1])), np.cumsum(costs, axis=0, dtype=np.float64)])
            totals[i:j] = sums[ends[i:j] - starts[i]] - sums[starts[i:j] - starts[i]]
        i = j
    return totals


_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any script."""
    offsets, data = text_buffers(column)
    sums = np.concatenate([[0], np.cumsum(_IS_LETTER[data])])
    out = sums[offsets[1:]] > sums[offsets[:-1]]
    wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
    for i in np.flatnonzero(~out & (wide[offsets[1:]] > wide[offsets[:-1]])):
        out[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return out


def _predicted(batches: Batches, shared: Broadcast) -> Batches:
    model: Model = shared.value
    for rows in slices(batches, "text"):
        column = rows.column("text")
        offsets, _ = text_buffers(column)
        sizes = np.diff(offsets)
        named = has_letter(column) & (len(model.languages) > 0)
        lang, score, bits = [UNKNOWN] * len(column), np.zeros(len(column)), np.full(len(column), np.nan)
        if named.any():
            lengths = code_lengths(model, column)
            best = lengths.argmin(axis=1)
            least = lengths.min(axis=1)
            with np.errstate(over="ignore", under="ignore"):
                score = np.where(named, 1 / np.exp2(least[:, None] - lengths).sum(axis=1), 0.0)
            bits = np.where(named, least / np.maximum(sizes, 1), np.nan)
            lang = [model.languages[b] if k else UNKNOWN for b, k in zip(best, named)]
        columns = {n: rows.column(n) for n in rows.schema.names}
        columns |= {
            "lang_pred": pa.array(lang, pa.string()),
            "score": pa.array(score, pa.float64()),
            "bits_per_byte": pa.array(bits, pa.float64(), mask=np.isnan(bits)),
        }
        yield batch(**columns)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs`` with lang_pred, score and bits_per_byte, from text alone.

    ``score`` is the share of the language in the sum of 2**-bits over all languages. A null text
    or one without a letter is ``und`` with score 0 and null bits, and so is every text when
    nothing was learned. Of equal code lengths the first language by name wins. One row per row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)
    names = [c for c in keep if c != "text"]
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in names], "text string, lang_pred string, score double, bits_per_byte double"])
    found = map_batches(docs.select(*names, "text"), partial(_predicted, shared=shared), schema)
    return found if "text" in keep else found.drop("text")


def in_a_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, with all their columns.

    Rejected: und, and texts that no language's model codes in under 8 bits a byte.
    """
    names = docs.columns
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}" if c != "text" else "text") for i, c in enumerate(names)])
    found = predict(renamed, model, tuple(renamed.columns))
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < RAW_BITS))
    return kept.select(*[F.col(old).alias(new) for old, new in zip(renamed.columns, names)])
