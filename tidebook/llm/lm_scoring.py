"""LM scoring with a log-frequency Bloom filter of word n-grams.

Words and word pairs of all training documents are counted by their hashes, and the counts quantised
to levels (1, 2, 3, 4, 6, 8, 12, ...). A gram of level q is entered in the filter q times, with the
level as part of its key; asking for levels 1, 2, ... until one is missing gives its level back, and
so bounds of its count. The filter has a part for each bucket of grams, made where the bucket is
counted and sized by what is entered there, so it is equally full whatever the corpus.

A filter of a whole corpus grows with it and has no bound that would allow a broadcast. It stays in
its parts, at every size: documents are gathered in units of some megabytes, a unit's distinct grams
are sent to the parts of their buckets, and the levels are sent back.

Probabilities of a word after another use the lower bound of the pair's count and the upper bound of
the first word's, so that those of all words after one word sum to 1 at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, binaries, longs, map_batches, run_starts
from tidebook.llm.words import LOWER_WORDS, Words, mix, slices, words_of
from tidebook.session import materialize

# Bits for each level entered and probe: half of the filter's bits are set.
BITS_EACH = 1.45
# Text of a bucket, whose counts are held in one task, and of a unit of documents.
BUCKET_BYTES = 4 << 20
UNIT_BYTES = 24 << 20
LEAST_BUCKETS = 16
LEAST_PROBES = 16
# Bits of a pair's key within its bucket.
SHORT = 40
# What a pair's share gives to the share of its second word.
BACKOFF = 0.4
UNITS_PER_TASK = 1 << 33
# Bytes of grams that a task answers at once.
CHUNK_BYTES = 8 << 20
_PIECE = 1 << 16

# The smallest count of each level, level 1 first.
THRESHOLDS = np.array(sorted({1 << k for k in range(62)} | {3 << k for k in range(60)}), np.int64)

_END = mix(np.array([0xE0D], np.uint64))[0]
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SINGLES, _PAIRS = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text's words and then one end, and their offsets."""
    n = len(words)
    offsets = words.offsets + np.arange(n + 1)
    out = np.full(offsets[-1], _END, np.uint64)
    out[np.arange(len(words.hashes)) + words.text(0)] = words.hashes
    return out, offsets


def _pairs(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash for every token with the one before it; a text's first token follows an end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1]] = _END
    return mix(before * _PAIR + tokens)


def _units(batches: Batches) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Documents of ``UNIT_BYTES`` of text together: their rows without text, tokens and offsets."""
    rows, tokens, ends, size = [], [], [np.zeros(1, np.int64)], 0

    def whole() -> tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]:
        return rows, np.concatenate(tokens), np.concatenate(ends)

    for part in slices(batches, "text"):
        found, offsets = _tokens(words_of(part.column("text"), LOWER_WORDS))
        rows.append(part.drop_columns(["text"]))
        tokens.append(found)
        ends.append(ends[-1][-1] + offsets[1:])
        size += part.nbytes
        if size >= UNIT_BYTES:
            yield whole()
            rows, tokens, ends, size = [], [], [np.zeros(1, np.int64)], 0
    if rows:
        yield whole()


# Bytes of whole numbers


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes of equal weight together, only as many as the largest needs."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + planes.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    width = blob[0]
    out = np.zeros(((len(blob) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8, offset=1).reshape(width, -1).T
    return out.view(np.uint64).ravel()


def _steps(grams: np.ndarray) -> bytes:
    """Sorted grams by their differences."""
    return _packed(np.diff(grams, prepend=np.uint64(0)))


def _from_steps(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob), dtype=np.uint64)


def _blobs(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def _squeezed(blob: bytes) -> bytes:
    return len(blob).to_bytes(8, "little") + pa.Codec("zstd").compress(blob, asbytes=True)


def _unsqueezed(blob: bytes) -> bytes:
    return pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def _cuts(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted grams. Buckets go by the upper bits."""
    edges = np.arange(1, buckets, dtype=np.uint64) << np.uint64(65 - buckets.bit_length())
    return np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])


def _short(grams: np.ndarray, buckets: int) -> np.ndarray:
    """The bits of grams that follow those of the bucket."""
    return (grams << np.uint64(buckets.bit_length() - 1)) >> np.uint64(64 - SHORT)


def _by_bucket(singles: np.ndarray, pairs: np.ndarray, buckets: int) -> Iterator[tuple[int, slice, slice]]:
    """Buckets that sorted grams fall into, and where."""
    a, b = _cuts(singles, buckets), _cuts(pairs, buckets)
    for i in np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0)).tolist():
        yield i, slice(a[i], a[i + 1]), slice(b[i], b[i + 1])


# Counting and the filter


def _count_grams(batches: Batches, buckets: int) -> Batches:
    """Words and pairs of every unit with their counts, by bucket."""
    for _, tokens, offsets in _units(batches):
        singles, n_singles = np.unique(tokens, return_counts=True)
        pairs, n_pairs = np.unique(_pairs(tokens, offsets), return_counts=True)
        short = _short(pairs, buckets)
        places = list(_by_bucket(singles, pairs, buckets))
        yield batch(
            bucket=pa.array([i for i, _, _ in places], pa.int32()),
            singles=_blobs([_steps(singles[a]) for _, a, _ in places]),
            n_singles=_blobs([_packed(n_singles[a]) for _, a, _ in places]),
            pairs=_blobs([_steps(short[b]) for _, _, b in places]),
            n_pairs=_blobs([_packed(n_pairs[b]) for _, _, b in places]),
        )


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for part in batches:
        for i in range(part.num_rows):
            yield part.slice(i, 1).to_pylist()[0]


def _summed(grams: list[bytes], times: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([_from_steps(g) for g in grams])
    order = np.argsort(every, kind="stable")
    every = every[order]
    starts = run_starts(every)
    counts = np.concatenate([_unpacked(t) for t in times])[order]
    return every[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _hashed(grams: np.ndarray, level: int, kind: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    first = mix(grams ^ kind ^ mix(np.array([level], np.uint64)))
    return first, mix(first) | np.uint64(1)


def _place(hashed: tuple[np.ndarray, np.ndarray], probe: int, size: int) -> np.ndarray:
    at = (hashed[0] + np.uint64(probe) * hashed[1]) >> np.uint64(32)
    return ((at * np.uint64(size)) >> np.uint64(32)).astype(np.int64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, counts.astype(np.int64), side="right")


def _filter_parts(batches: Batches, probes: int) -> Batches:
    """The filter's part of every bucket, and its words with their exact counts. Rows come by
    bucket; one bucket's counts are held."""
    for bucket, group in groupby(_rows_of(batches), key=lambda row: row["bucket"]):
        rows = list(group)
        singles, n_singles = _summed([r["singles"] for r in rows], [r["n_singles"] for r in rows])
        pairs, n_pairs = _summed([r["pairs"] for r in rows], [r["n_pairs"] for r in rows])
        kinds = [(singles, levels_of(n_singles), _SINGLES), (pairs, levels_of(n_pairs), _PAIRS)]
        size = 64 * math.ceil(BITS_EACH * probes * sum(int(levels.sum()) for _, levels, _ in kinds) / 64)
        flags = np.zeros(size, bool)
        for grams, levels, kind in kinds:
            for level in range(1, int(levels.max(initial=0)) + 1):
                hashed = _hashed(grams[levels >= level], level, kind)
                for probe in range(probes):
                    flags[_place(hashed, probe, size)] = True
        yield batch(
            bucket=pa.array([bucket], pa.int32()),
            size=longs(np.array([size])),
            n_set=longs(np.array([np.count_nonzero(flags)])),
            n_tokens=longs(np.array([n_singles.sum()], np.int64)),
            n_distinct=longs(np.array([len(singles)])),
            bits=binaries([np.packbits(flags, bitorder="little")]),
            singles=_blobs([_steps(singles)]),
            n_singles=_blobs([_packed(n_singles)]),
        )


def probed(grams: np.ndarray, kind: np.uint64, bits: np.ndarray, size: int, probes: int) -> np.ndarray:
    """Levels of grams, 0 for unknown ones, by probing one level after the other."""
    out = np.zeros(len(grams), np.uint8)
    for start in range(0, len(grams) if size else 0, _PIECE):
        piece = grams[start : start + _PIECE]
        left = np.arange(len(piece))
        for level in range(1, len(THRESHOLDS) + 1):
            first, second = _hashed(piece[left], level, kind)
            for probe in range(probes):
                at = _place((first, second), probe, size)
                hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                if not hit.all():
                    left, first, second = left[hit], first[hit], second[hit]
            if not len(left):
                break
            out[start + left] = level
    return out


@dataclass
class Model:
    """The filter in ``parts``, a row for each bucket, and the number of training tokens and of
    distinct ones. ``fill`` is the share of bits that are set."""

    parts: DataFrame
    buckets: int
    probes: int
    n_tokens: int
    n_distinct: int
    fill: float

    def vocabulary(self) -> DataFrame:
        """(gram, n): hashes of all training tokens with their exact counts."""
        return map_batches(self.parts.select("singles", "n_singles"), _listed, "gram long, n long")


def _listed(batches: Batches) -> Batches:
    for row in _rows_of(batches):
        yield batch(gram=longs(_from_steps(row["singles"])), n=longs(_unpacked(row["n_singles"]).astype(np.int64)))


def fit(docs: DataFrame) -> Model:
    """The model of all of ``docs`` (text).

    The number of probes grows with the logarithm of the corpus, so that after any word far less than
    one word of the whole vocabulary is wrongly taken for known, on the average.
    """
    texts = docs.select("text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, 1 << (size // BUCKET_BYTES).bit_length())
    probes = max(LEAST_PROBES, (size >> 9).bit_length())
    grams = map_batches(
        texts, partial(_count_grams, buckets=buckets), "bucket int, singles binary, n_singles binary, pairs binary, n_pairs binary"
    )
    by_bucket = grams.repartition("bucket").sortWithinPartitions("bucket")
    schema = "bucket int, size long, n_set long, n_tokens long, n_distinct long, bits binary, singles binary, n_singles binary"
    parts = materialize(map_batches(by_bucket, partial(_filter_parts, probes=probes), schema), "filter")
    sums = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("size", "n_set", "n_tokens", "n_distinct")]).first()
    return Model(parts, buckets, probes, sums["n_tokens"], sums["n_distinct"], sums["n_set"] / max(sums["size"], 1))


def token_shares(model_size: tuple[int, int, int], single: np.ndarray, before: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Probabilities of tokens after others, from the levels of the token, the one before and both.

    ``model_size`` has the number of tokens, of distinct ones and of probes. A pair's share is its
    least count by the most that the first word's can be, and one more and the expected number for
    words that the filter wrongly knows after it; a word's share is its least count and a half. They
    are mixed by ``BACKOFF``, or the word's share is taken alone where the first word is unknown.
    Shares of all words after one word sum to 1 at most, unless the filter is wrong about more words.
    """
    n_tokens, n_distinct, probes = model_size
    least = np.concatenate([[0.0], THRESHOLDS.astype(float)])
    most = np.concatenate([[0.0], THRESHOLDS[1:].astype(float) - 1, [float(THRESHOLDS[-1]) * 2]])
    alone = (least[single] + 0.5) / (n_tokens + 0.5 * (n_distinct + 1))
    joint = least[pair] / (most[before] + 1 + n_distinct * 2.0**-probes)
    return np.where(before > 0, (1 - BACKOFF) * np.minimum(joint, 1) + BACKOFF * alone, alone)


# Scoring


UNITS = "unit long, doc_id array<long>, singles binary, places binary, ends binary"


def _gathered(batches: Batches) -> Batches:
    """A row for each unit of documents: its distinct tokens, and each token's place among them, the
    commonest first, as most places are small numbers then."""
    unit = TaskContext.get().partitionId() * UNITS_PER_TASK
    for rows, tokens, offsets in _units(batches):
        singles, where, n = np.unique(tokens, return_inverse=True, return_counts=True)
        rank = np.empty(len(n), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(n))
        ids = pa.concat_arrays([r.column("doc_id") for r in rows])
        yield batch(
            unit=longs(np.array([unit])),
            doc_id=pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            singles=_blobs([_steps(singles)]),
            places=_blobs([_squeezed(_packed(rank[where]) + _packed(rank))]),
            ends=_blobs([_packed(offsets)]),
        )
        unit += 1


def _tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a unit: distinct tokens, each token's place among them, and where documents end."""
    singles, offsets = _from_steps(row["singles"]), _unpacked(row["ends"]).astype(np.int64)
    blob = _unsqueezed(row["places"])
    cut = 1 + blob[0] * int(offsets[-1])
    of_rank = np.empty(len(singles), np.int64)
    of_rank[_unpacked(blob[cut:]).astype(np.int64)] = np.arange(len(singles))
    return singles, of_rank[_unpacked(blob[:cut]).astype(np.int64)], offsets


def _asked(batches: Batches, buckets: int) -> Batches:
    """The distinct grams of every unit by bucket."""
    for row in _rows_of(batches):
        singles, where, offsets = _tokens_of(row)
        pairs = np.unique(_pairs(singles[where], offsets))
        short = _short(pairs, buckets)
        places = list(_by_bucket(singles, pairs, buckets))
        yield batch(
            bucket=pa.array([i for i, _, _ in places], pa.int32()),
            unit=longs(np.full(len(places), row["unit"])),
            singles=_blobs([_steps(singles[a]) for _, a, _ in places]),
            pairs=_blobs([_steps(short[b]) for _, _, b in places]),
        )


def _chunks(rows: Iterable[dict]) -> Iterator[list[dict]]:
    """Rows in lists of about ``CHUNK_BYTES`` of grams."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["singles"]) + len(row["pairs"])
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _answered(batches: Batches, probes: int) -> Batches:
    """Levels of the grams asked for and counts of the words. Rows come by bucket, its part of the
    filter first; of a bucket without one, nothing is known. A gram that many units ask for is
    probed once."""
    for bucket, group in groupby(_rows_of(batches), key=lambda row: row["bucket"]):
        first = next(group)
        rows = group if first["unit"] < 0 else chain([first], group)
        size, bits, known, counts = 0, np.zeros(0, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if first["unit"] < 0:
            size, bits = first["size"], np.frombuffer(first["bits"], np.uint8)
            known, counts = _from_steps(first["singles"]), _unpacked(first["n_singles"])
        for chunk in _chunks(rows):
            singles, pairs = ([_from_steps(row[name]) for row in chunk] for name in ("singles", "pairs"))
            levels, exact = [], np.zeros(0, np.uint64)
            for asked, kind in ((singles, _SINGLES), (pairs, _PAIRS)):
                distinct, where = np.unique(np.concatenate(asked), return_inverse=True)
                levels.append(probed(distinct, kind, bits, size, probes)[where])
                if kind == _SINGLES:
                    exact = np.zeros(len(distinct), np.uint64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
                        exact = np.where(known[at] == distinct, counts[at], exact)
                    exact = exact[where]
            ends = [np.cumsum([0, *map(len, asked)]) for asked in (singles, pairs)]
            yield batch(
                unit=longs(np.array([row["unit"] for row in chunk])),
                bucket=pa.array([bucket] * len(chunk), pa.int32()),
                levels=binaries([levels[0][a:b] for a, b in zip(ends[0][:-1], ends[0][1:])]),
                counts=_blobs([_packed(exact[a:b]) for a, b in zip(ends[0][:-1], ends[0][1:])]),
                pair_levels=binaries([levels[1][a:b] for a, b in zip(ends[1][:-1], ends[1][1:])]),
            )


def _scored(batches: Batches, sizes: tuple[int, int, int]) -> Batches:
    """Per document its tokens and scores. Rows come by unit, the unit itself before its answers."""
    n_tokens, n_distinct, _ = sizes
    floor = n_tokens + 0.5 * (n_distinct + 1)
    for _, group in groupby(_rows_of(batches), key=lambda row: row["unit"]):
        head = next(group)
        singles, where, offsets = _tokens_of(head)
        pairs, which = np.unique(_pairs(singles[where], offsets), return_inverse=True)
        answers = list(group)
        levels = np.concatenate([np.frombuffer(r["levels"], np.uint8) for r in answers])
        exact = np.concatenate([_unpacked(r["counts"]) for r in answers]).astype(np.float64)
        pair_levels = np.concatenate([np.frombuffer(r["pair_levels"], np.uint8) for r in answers])
        if len(levels) != len(singles) or len(pair_levels) != len(pairs):
            raise ValueError(f"{len(levels)} and {len(pair_levels)} levels for {len(singles)} and {len(pairs)} n-grams")
        single = levels[where]
        before = np.empty_like(single)
        before[1:] = single[:-1]
        before[offsets[:-1]] = levels[np.searchsorted(singles, _END)]
        score = np.log10(token_shares(sizes, single, before, pair_levels[which])) if n_distinct else np.zeros(len(where))
        base = np.log10((exact + 0.5) / floor)[where]
        starts = offsets[:-1]
        yield batch(
            doc_id=pa.array(head["doc_id"], pa.int64()),
            n_tokens=longs(np.diff(offsets)),
            n_known=longs(np.add.reduceat((exact > 0).astype(np.int64)[where], starts)),
            base_score=pa.array(np.add.reduceat(base, starts)),
            score=pa.array(np.add.reduceat(score, starts)),
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, base_score, score.

    Tokens are runs without blanks (A-Z as a-z) and one end; a null text is empty and has the end
    only. ``base_score`` and ``n_known`` use exact counts. ``score`` is the model's log10
    probability of the text, or 0 if nothing was learned. Repeated rows get equal results, and rows
    of equal or null id are documents of their own. Other columns are ignored. An empty table gives
    no rows.
    """
    held = materialize(map_batches(docs.select("doc_id", "text"), _gathered, UNITS), "units")
    asked = map_batches(held, partial(_asked, buckets=model.buckets), "bucket int, unit long, singles binary, pairs binary")
    parts = model.parts.select("bucket", F.lit(-1).cast("long").alias("unit"), "singles", "size", "bits", "n_singles")
    by_bucket = parts.unionByName(asked, allowMissingColumns=True).repartition("bucket").sortWithinPartitions("bucket", "unit")
    answers = map_batches(
        by_bucket, partial(_answered, probes=model.probes), "unit long, bucket int, levels binary, counts binary, pair_levels binary"
    )
    both = held.withColumn("bucket", F.lit(-1)).unionByName(answers, allowMissingColumns=True)
    by_unit = both.repartition("unit").sortWithinPartitions("unit", "bucket")
    sizes = (model.n_tokens, model.n_distinct, model.probes)
    return map_batches(by_unit, partial(_scored, sizes=sizes), "doc_id long, n_tokens long, n_known long, base_score double, score double")
