"""Substring dedup by seed and extend: words inside long passages that occur more than once go.

A window is ``WINDOW`` consecutive words of one document. Its seed is the smallest (the last of
equals) of the hashes of the runs of ``SEED`` words in it, so equal windows have equal seeds at the
same place: the seeds are winnowed anchors, one for some twelve windows.

1. Seeds are counted over all documents. Those found twice or more go into a Bloom filter whose
   size is bounded; what it lets pass by mistake costs rows, not exactness.
2. Documents are joined on these seeds: each occurrence carries the hashes of the windows that it
   extends to on both sides, and windows found twice among a seed's occurrences are repeats.
   A seed with very many occurrences is dealt over many tasks, and the windows that are single
   in every one of these tasks' shares are counted together afterwards.
3. Adjacent repeated windows of a document join into maximal repeats, whose words are removed.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, longs, map_batches, run_starts, whole_groups
from tidebook.llm.bloom import bloom_filter, passes
from tidebook.llm.words import EXACT_WORDS, Words, grams, mix, slices, words_of
from tidebook.session import materialize

WINDOW = 35
SEED = 12
# Bits of the filter: at most this many (16 MB).
FILTER_BITS = 1 << 27
# Occurrences of a seed that one task handles; seeds above it are split, whatever the corpus.
SHARE = 4_000
# Up to so many split seeds are told to all tasks (16 bytes each); more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000


def _seeds(words: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window inside one text: its first word, and its seed's value and place."""
    counts = np.maximum(np.diff(words.offsets) - window + 1, 0)
    ends = np.cumsum(counts)
    starts = np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.offsets[:-1] - (ends - counts), counts)
    values = grams(words.hashes, seed)
    places = np.arange(len(values))
    width, span = window - seed + 1, 1

    def smaller(a: slice, b: slice) -> None:
        nonlocal values, places
        right = values[b] <= values[a]
        values, places = np.where(right, values[b], values[a]), np.where(right, places[b], places[a])

    while 2 * span <= width and len(values) > span:
        smaller(slice(None, -span), slice(span, None))
        span *= 2
    if span < width and len(values) > width - span:
        smaller(slice(None, span - width), slice(width - span, None))
    return starts, values[starts], places[starts]


def _count_seeds(batches: Batches, window: int, seed: int) -> Batches:
    for rows in slices(batches, "text"):
        _, values, places = _seeds(words_of(rows.column("text"), EXACT_WORDS), window, seed)
        found, times = np.unique(values[run_starts(places)], return_counts=True)
        yield batch(seed=longs(found), n=longs(times))


def _occurrences(batches: Batches, window: int, seed: int, shared: Broadcast) -> Batches:
    """Each occurrence of a seed that passes: document, first window, hashes of its windows, and a
    draw that tells its share if the seed is split."""
    found = shared.value
    for rows in slices(batches, "text"):
        words = words_of(rows.column("text"), EXACT_WORDS)
        starts, values, places = _seeds(words, window, seed)
        runs = run_starts(places)
        ends = np.concatenate([runs[1:], [len(places)]]).astype(np.int64)
        keep = passes(found, values[runs])
        runs, ends = runs[keep], ends[keep]
        hashes = grams(words.hashes, window)
        lengths = ends - runs
        flat = np.repeat(runs, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        text = np.searchsorted(words.offsets, starts[runs], side="right") - 1
        key = rows.column("key").to_numpy()[text]
        draw = mix(key.view(np.uint64) ^ mix(starts[runs].astype(np.uint64)))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        raw = hashes[starts[flat]].tobytes()
        yield batch(
            seed=longs(values[runs]),
            draw=longs(draw),
            key=longs(key),
            first=longs(starts[runs] - words.offsets[text]),
            windows=pa.Array.from_buffers(
                pa.binary(), len(runs), [None, pa.py_buffer((bounds * 8).astype(np.int32)), pa.py_buffer(raw)]
            ),
        )


def _repeats(batches: Batches) -> Batches:
    """Runs of windows found twice within a share of a seed. Rows sorted by seed, salt.

    Of a split seed, also every window once per share: with its place if it is single there.
    """
    for rows in whole_groups(_with_group(batches), "group"):
        group, salt, key, first = (rows.column(c).to_numpy() for c in ("group", "salt", "key", "first"))
        blobs = rows.column("windows").to_pylist()
        lengths = np.array([len(b) // 8 for b in blobs])
        windows = np.frombuffer(b"".join(blobs), np.uint64)
        row = np.repeat(np.arange(len(blobs)), lengths)
        start = first[row] + np.arange(len(windows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        order = np.lexsort((windows, group[row]))
        w, g = windows[order], group[row][order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (g[1:] != g[:-1])
        runs = np.flatnonzero(new)
        times = np.diff(np.concatenate([runs, [len(w)]]))
        repeated = np.zeros(len(w), bool)
        repeated[order] = np.repeat(times > 1, times)
        at = np.flatnonzero(repeated)
        begin = np.ones(len(at), bool)
        begin[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
        heads = np.flatnonzero(begin)
        tails = np.concatenate([heads[1:], [len(at)]]) - 1
        a, b = at[heads], at[tails] if len(heads) else at[:0]
        shared = order[runs[salt[row[order[runs]]] > 0]]
        single = ~repeated[shared]
        seed = rows.column("seed").to_numpy()[row[shared]]
        yield batch(
            key=pa.concat_arrays([longs(key[row[a]]), pa.array(key[row[shared]], mask=~single)]),
            start=longs(np.concatenate([start[a], start[shared]])),
            last=longs(np.concatenate([start[b], start[shared]])),
            seed=pa.concat_arrays([pa.nulls(len(a), pa.int64()), longs(seed)]),
            window=pa.concat_arrays([pa.nulls(len(a), pa.int64()), longs(windows[shared])]),
        )


def _with_group(batches: Batches) -> Batches:
    """A single key for (seed, salt)."""
    for rows in batches:
        seed, salt = (rows.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("seed", "salt"))
        yield pa.RecordBatch.from_arrays([*rows.columns, longs(seed ^ mix(salt))], [*rows.schema.names, "group"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(key, spans): per document with repeats, [first, last] window starts of its runs of repeats.

    ``docs`` has key (long, never null) and text.
    """
    spark = docs.sparkSession
    seeds = map_batches(docs.select("text"), partial(_count_seeds, window=window, seed=seed), "seed long, n long")
    repeated = materialize(seeds.groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1"), "seeds")
    n_repeated = repeated.count()
    split = materialize(
        repeated.filter(F.col("n") > SHARE).select("seed", (F.col("n") / SHARE + 1).cast("long").alias("shares")), "split"
    )
    if split.count() <= BROADCAST_SEEDS:
        split = F.broadcast(split)
    shared = spark.sparkContext.broadcast(bloom_filter(repeated.select("seed"), n_repeated, FILTER_BITS))
    occurrences = map_batches(
        docs.select("key", "text"),
        partial(_occurrences, window=window, seed=seed, shared=shared),
        "seed long, draw long, key long, first long, windows binary",
    )
    salt = F.coalesce(F.pmod("draw", "shares") + 1, F.lit(0).cast("long")).alias("salt")
    salted = occurrences.join(split, "seed", "left").select("seed", salt, "key", "first", "windows")
    dealt = salted.repartition("seed", "salt").sortWithinPartitions("seed", "salt")
    found = materialize(
        map_batches(dealt, _repeats, "key long, start long, last long, seed long, window long"), "repeats"
    )
    between = found.filter("seed IS NOT NULL")
    several = between.groupBy("seed", "window").agg(F.count("*").alias("n")).filter("n > 1")
    late = between.filter("key IS NOT NULL").join(several, ["seed", "window"], "left_semi")
    spans = found.filter("seed IS NULL").select("key", "start", "last").union(late.select("key", "start", "last"))
    return spans.groupBy("key").agg(F.collect_list(F.struct("start", "last")).alias("spans"))


def _removed(words: Words, i: int, spans: list, window: int) -> np.ndarray:
    """Which words of text i lie in a repeated window."""
    n = words.offsets[i + 1] - words.offsets[i]
    change = np.zeros(n + 1, np.int64)
    for span in spans or ():
        change[span["start"]] += 1
        change[span["last"] + window] -= 1
    return np.cumsum(change[:-1]) > 0


def _cut(batches: Batches, window: int, as_text: bool) -> Batches:
    for rows in slices(batches, "text"):
        words = words_of(rows.column("text"), EXACT_WORDS)
        spans = rows.column("spans").to_pylist()
        texts = rows.column("text")
        kept, n_removed = [], []
        for i in range(len(words)):
            a, b = words.offsets[i], words.offsets[i + 1]
            gone = _removed(words, i, spans[i], window)
            n_removed.append(int(gone.sum()))
            if as_text and not gone.any():
                kept.append(texts[i].as_py())
            elif as_text:
                kept.append(_without(words, i, gone))
            else:
                data = words.data
                kept.append(
                    b" ".join([data[s:e].tobytes() for s, e in zip(words.starts[a:b][~gone], words.ends[a:b][~gone])])
                    if gone.any()
                    else b" ".join(_bytes_of(words, i).split())
                )
        columns = {n: rows.column(n) for n in rows.schema.names if n not in ("text", "spans")}
        columns["text"] = pa.array([k.decode() if isinstance(k, bytes) else k for k in kept], pa.string())
        columns["n_words"] = longs(np.diff(words.offsets))
        columns["n_removed"] = pa.array(n_removed, pa.int64())
        yield batch(**columns)


def _bytes_of(words: Words, i: int) -> bytes:
    a, b = words.offsets[i], words.offsets[i + 1]
    return words.data[words.starts[a] : words.ends[b - 1]].tobytes() if b > a else b""


def _without(words: Words, i: int, gone: np.ndarray) -> bytes:
    """The text from its first to its last word, without removed words and the blanks after them."""
    a, b = words.offsets[i], words.offsets[i + 1]
    starts, ends = words.starts[a:b], words.ends[a:b]
    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=1, append=1))
    parts = [words.data[starts[x] : starts[y] if y < len(starts) else ends[-1]].tobytes() for x, y in zip(edge[::2], edge[1::2])]
    return b"".join(parts).rstrip(b" \t\n\r\x0b\x0c") if parts else b""


def cut_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, as_text: bool = True) -> DataFrame:
    """``docs`` with n_words and n_removed, and with text that has lost its repeated words.

    Words are runs without blanks, unchanged. A word goes if a window of ``window`` words of the
    input that covers it also starts anywhere else, in the same document or another. ``as_text``: a
    text without repeats stays as it is (null too), else what is left keeps its blanks; otherwise
    text becomes the kept words joined by one space (null: empty). Rows with equal id and text are
    documents of their own and repeat each other. Other columns pass through, but for those called
    n_words, n_removed, key or spans, which are replaced or dropped.
    """
    docs = docs.drop("n_words", "n_removed", "key", "spans")
    # Rows of one id and text have equal spans, so they may share a key.
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(keyed.select("key", "text"), window, seed)
    joined = keyed.join(spans.hint("shuffle_hash"), "key", "left").drop("key")
    order = [*docs.columns, "n_words", "n_removed"]
    fields = [*[f for f in joined.schema.fields if f.name not in ("text", "spans")]]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "text string, n_words long, n_removed long"])
    return map_batches(joined, partial(_cut, window=window, as_text=as_text), schema).select(*order)
