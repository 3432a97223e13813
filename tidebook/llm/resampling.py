"""Importance resampling towards a target: documents drawn by hashed n-gram gains.

An untrained ``Split`` of the tokenizers library cuts ASCII-lowered texts into words with offsets.
The words are put next to each other with one blank between, and the pairs (start of a word, end of
a word up to two further) are the windows whose bytes are the features. A feature's bucket is the
CRC-32 of its bytes modulo the number of buckets.

CRCs are taken for all words of a slice together, and a window's CRC follows from those of its words:
appending n bytes to a message multiplies its CRC by a fixed matrix and adds the CRC of those bytes.
Windows with a word of more than ``LONGEST`` bytes are summed byte by byte instead.

Texts are cut into words once; the buckets are written, two bytes for a feature (four beyond 65,536
buckets), and read for the histogram and again for the weights. Histograms have a row for each
bucket and task; ranks come from a sort by ranges, so no task or driver holds more than its part.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, binaries, longs, map_batches
from tidebook.llm.words import slices
from tidebook.operators.ranking import numbered
from tidebook.session import materialize

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST_RUN = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
LONGEST = 62
_BLANK = 0x20


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(PATTERN), "removed", invert=True)


def lowered(text: str) -> str:
    """A-Z as a-z; everything else unchanged."""
    return text.encode("utf-8", "replace").lower().decode()


def words_with_offsets(text: str | None) -> list[tuple[str, tuple[int, int]]]:
    """Words of the lowered text, with the places of their first character and after their last."""
    return _splitter().pre_tokenize_str(lowered(text)) if text else []


# CRC-32 of many byte strings


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_TABLE = _crc_table()


@lru_cache(maxsize=1)
def _appended() -> np.ndarray:
    """[n, k, b]: the CRC of byte b at place k of a CRC (lowest first) after n further zero bytes."""
    steps = np.empty((LONGEST + 2, 4, 256), np.uint32)
    steps[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))
    for n in range(1, LONGEST + 2):
        steps[n] = _TABLE[steps[n - 1] & np.uint32(255)] ^ (steps[n - 1] >> np.uint32(8))
    return steps


def appended(crcs: np.ndarray, sizes: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """CRC-32 of messages after which other messages, of these sizes and CRCs, are appended."""
    steps, out = _appended(), tails.copy()
    for k in range(4):
        out ^= steps[sizes, k, (crcs >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of words of at most ``LONGEST`` bytes (others: of their first bytes), byte by byte for
    all words at a time."""
    short = np.minimum(sizes, LONGEST).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    at, left = starts[order], np.sort(short)
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for j in range(int(left[-1]) if len(left) else 0):
        n = len(left) - int(np.searchsorted(left, j, side="right"))
        low = (state[:n] ^ data[at[:n] + j]) & np.uint32(255)
        state[:n] = _TABLE[low] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    return out


def _windows(data: np.ndarray, ends: np.ndarray, of: np.ndarray, runs: int) -> list[np.ndarray]:
    """CRC-32 of all runs of 1, 2, ... words within a text; ``of`` is the text of every word."""
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    sizes = ends - starts
    crcs = word_crcs(data, starts, sizes)
    short = np.minimum(sizes, LONGEST)
    blank = np.full(len(crcs), zlib.crc32(b" "), np.uint32)
    spaced = appended(blank, short, crcs)
    raw = data.tobytes() if (sizes > LONGEST).any() else b""
    far = np.flatnonzero(sizes > LONGEST)
    for i in far:
        crcs[i] = zlib.crc32(raw[starts[i] : ends[i]])
    out = [crcs]
    for n in range(1, runs):
        whole = appended(out[-1][:-1], short[n:] + 1, spaced[n:])
        inside = of[n:] == of[:-n] if n < len(of) else np.empty(0, bool)
        for i in np.unique(far[:, None] - np.arange(n + 1)[None, :]) if len(far) else ():
            if 0 <= i < len(inside) and inside[i]:
                whole[i] = zlib.crc32(raw[starts[i] : ends[i + n]])
        whole = whole.copy()
        out.append(np.where(inside, whole, 0).astype(np.uint32) if len(whole) else whole)
    for n in range(1, runs):
        out[n] = out[n][of[n:] == of[:-n]] if n < len(of) else out[n][:0]
    return out


def _cut(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words with one blank between, where each word ends, and each text's words."""
    joined, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = words_with_offsets(text)
        if found:
            counts[i] = len(found)
            joined.append(" ".join([word for word, _ in found]))
    data = np.frombuffer(" ".join(joined).encode(), np.uint8)
    ends = np.append(np.flatnonzero(data == _BLANK), len(data)) if len(data) else np.empty(0, np.int64)
    return data, ends, counts


def _features(batches: Batches, buckets: int, runs: int) -> Batches:
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    for rows in slices(batches, "text"):
        data, ends, counts = _cut(rows.column("text").to_pylist())
        crcs = _windows(data, ends, np.repeat(np.arange(len(counts)), counts), runs)
        found = [(c % np.uint32(buckets)).astype(kind) for c in crcs]
        sizes = [np.maximum(counts - n, 0) for n in range(runs)]
        edges = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
        blobs = [np.concatenate([f[e[i] : e[i + 1]] for f, e in zip(found, edges)]) for i in range(len(counts))]
        yield pa.RecordBatch.from_arrays(
            [*rows.columns[1:], longs(counts), longs(sum(sizes)), binaries(blobs)],
            [*rows.schema.names[1:], "n_words", "n_features", "buckets"],
        )


def features(docs: DataFrame, buckets: int = BUCKETS, runs: int = LONGEST_RUN) -> DataFrame:
    """Per row: doc_id, n_words, n_features, and the buckets of its features, repeats included, as
    whole numbers of two bytes (four beyond 65,536 buckets). A null text has no words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_features long, buckets binary"
    return map_batches(docs.select("text", "doc_id"), partial(_features, buckets=buckets, runs=runs), schema)


def _buckets_of(rows: pa.RecordBatch, kind: type) -> tuple[np.ndarray, np.ndarray]:
    column = rows.column("buckets").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.empty(0, np.uint8)
    return flat.view(kind), (edges - edges[0]) // np.dtype(kind).itemsize


def _histogram(batches: Batches, buckets: int, kind: type) -> Batches:
    counts = np.zeros(buckets, np.int64)
    for rows in batches:
        counts += np.bincount(_buckets_of(rows, kind)[0], minlength=buckets)
    full = np.flatnonzero(counts)
    yield batch(bucket=longs(full), n=longs(counts[full]))


def histogram(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs among the features of all rows."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    parts = map_batches(featured.select("buckets"), partial(_histogram, buckets=buckets, kind=kind), "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much commoner each bucket is in the target, rounded down."""
    s, t, k = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.array(
        [math.floor(1000 * math.log(((x + 1.0) * (s + k)) / ((y + 1.0) * (t + k)))) for x, y in zip(target, corpus)], np.int64
    )


def _weighed(batches: Batches, gain: np.ndarray, kind: type) -> Batches:
    for rows in batches:
        found, edges = _buckets_of(rows, kind)
        sums = np.concatenate([[0], np.cumsum(gain[found])])
        columns = [rows.column(c) for c in ("doc_id", "n_words", "n_features")]
        yield pa.RecordBatch.from_arrays(
            [*columns, longs(sums[edges[1:]] - sums[edges[:-1]])], ["doc_id", "n_words", "n_features", "weight"]
        )


def noise(seed: int):
    """A Gumbel draw of each document, in thousandths, rounded down, from a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, runs: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight (sum of gains), score (weight and noise)."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    featured = materialize(features(docs, buckets, runs), "features")
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, runs)
    gain = gains(histogram(featured, buckets), histogram(wanted, buckets))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    weighed = map_batches(featured, partial(_weighed, gain=gain, kind=kind), schema)
    return weighed.withColumn("score", F.col("weight") + noise(seed))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    runs: int = LONGEST_RUN,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_features, weight, score, rank.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are
    drawn without replacement: those of the highest scores, ties to the smaller id, null ids last.
    They have ranks from 1; the others' rank is null. A null text has no words, weight 0 and no
    rank; a null id is hashed as an empty one. Repeated rows and equal ids are rows of their own
    (with equal scores, if their texts are equal). Other columns of both tables are ignored. Without
    documents there are no rows; with an empty target, every document is weighed against even counts.
    """
    weighed = materialize(weigh(docs, target, buckets, runs, seed), "weighed")
    fit = F.col("n_words") >= least_words
    draw = weighed.filter(fit).count() * percent // 100
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked = numbered(weighed.filter(fit), order, "long")
    rank = F.when(F.col("position") <= draw, F.col("position"))
    drawn = ranked.withColumn("rank", rank).drop("position")
    return drawn.unionByName(weighed.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
