"""Benchmark decontamination with a distributed positional inverted index.

1. The words of all benchmark windows are counted in all documents (a Bloom filter of bounded size
   lets their occurrences through).
2. Of every window, the two rarest words are kept with their offsets. The index holds the postings
   of these words: document, position, and for a window's rarest word the words around it.
3. Lists are intersected from the rarest word on: positions less offsets must agree, or differ by
   at most ``slack`` for proximity matches. An exact match also compares every word of the window
   with the words that the posting carries.

For exact matches a common benchmark word's list never leaves the task that holds it: the words
around each of the postings are compared there, and only documents with a match bring a second list.
Proximity matches join the lists of both words by (window, document, place).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, binaries, longs, map_batches, unused
from tidebook.llm.bloom import bloom_filter, passes
from tidebook.llm.words import PLAIN_WORDS, mix, slices, words_of
from tidebook.session import materialize

WINDOW = 10
# Documents found are told to all tasks up to this number (8 bytes each); beyond it by a shuffle.
BROADCAST_KEYS = 1_000_000


def _windows(batches: Batches, window: int) -> Batches:
    """Windows of every item: a hash, the words' hashes, and their number."""
    for rows in slices(batches, "text"):
        words = words_of(rows.column("text"), PLAIN_WORDS)
        item, parts = [], []
        for i in range(len(words)):
            own = words.of(i)
            for k in range(max(1, len(own) - window + 1) if len(own) else 0):
                item.append(i)
                parts.append(own[k : k + window])
        prints = [_print(p) for p in parts]
        yield batch(
            item_id=rows.column("item_id").take(pa.array(item, pa.int64())),
            window=longs(np.array(prints, np.uint64)),
            words=pa.array([p.view(np.int64).tolist() for p in parts], pa.list_(pa.int64())),
            terms=binaries(parts),
        )


def _print(words: np.ndarray) -> int:
    value = np.array([len(words)], np.uint64)
    for w in words:
        value = mix(value * np.uint64(31) + w)
    return int(value[0])


def _prints(words: np.ndarray) -> np.ndarray:
    """``_print`` of every row of a matrix of words."""
    value = np.full(len(words), words.shape[1], np.uint64)
    for column in words.T:
        value = mix(value * np.uint64(31) + column)
    return value


def _count_terms(batches: Batches, terms: Broadcast) -> Batches:
    for rows in slices(batches, "text"):
        hashes = words_of(rows.column("text"), PLAIN_WORDS).hashes
        found, times = np.unique(hashes[passes(terms.value, hashes)], return_counts=True)
        yield batch(term=longs(found), n=longs(times))


def _postings(batches: Batches, window: int, anchors: Broadcast) -> Batches:
    """Per document its number of words, and the postings of the anchors' words in it."""
    rarest, second = anchors.value
    reach = window - 1
    for rows in slices(batches, "text"):
        words = words_of(rows.column("text"), PLAIN_WORDS)
        first = passes(rarest, words.hashes)
        at = np.flatnonzero(first | passes(second, words.hashes))
        text = np.searchsorted(words.offsets, at, side="right") - 1
        with_context = first[at]
        centre = at[with_context]
        place = centre[:, None] + np.arange(-reach, reach + 1)
        own = text[with_context]
        inside = (place >= words.offsets[own][:, None]) & (place < words.offsets[own + 1][:, None])
        around = np.where(inside, words.hashes[np.clip(place, 0, max(len(words.hashes) - 1, 0))], 0) if len(at) else place.astype(np.uint64)
        size = 8 * (2 * reach + 1)
        ends = np.concatenate([[0], np.cumsum(with_context)]) * size
        contexts = pa.Array.from_buffers(
            pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(around.astype(np.uint64).tobytes())]
        )
        counts = np.bincount(text, minlength=len(words)).astype(np.int64) if len(at) else np.zeros(len(words), np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))

        def per_text(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(offsets, values)

        yield batch(
            key=rows.column("key"),
            doc_id=rows.column("doc_id"),
            n_words=longs(np.diff(words.offsets)),
            terms=per_text(longs(words.hashes[at])),
            positions=per_text(longs(at - words.offsets[text])),
            contexts=per_text(contexts),
        )


def _filter_of(terms: DataFrame) -> np.ndarray:
    terms = terms.select("term").distinct()
    return bloom_filter(terms, terms.count())


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, window, words, terms): the windows of all items; terms are the words as bytes."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", "text")
    schema = f"item_id {kind}, window long, words array<long>, terms binary"
    return materialize(map_batches(rows, partial(_windows, window=window), schema), "windows")


def _anchors(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, terms, length, rank, term, offset): the two rarest words of every window that can
    occur, rank 1 the rarest; of equally rare ones the first."""
    spark = docs.sparkSession
    distinct = windows.dropDuplicates(["window"]).select("window", "words", "terms")
    terms = distinct.select("window", "terms", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
    found = spark.sparkContext.broadcast(_filter_of(terms))
    counted = map_batches(docs.select("text"), partial(_count_terms, terms=found), "term long, n long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n"))
    ranked = terms.join(counted, "term", "left").groupBy("window").agg(
        F.first("terms").alias("terms"),
        F.first("length").alias("length"),
        F.count_if(F.col("n").isNull()).alias("missing"),
        F.slice(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))), 1, 2).alias("rare"),
    )
    return materialize(
        ranked.filter("missing = 0")
        .select("window", "terms", "length", F.posexplode("rare").alias("rank", "r"))
        .select("window", "terms", "length", (F.col("rank") + 1).alias("rank"), "r.term", "r.offset"),
        "anchors",
    )


def with_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that only rows of equal id and text share."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def positional_index(docs: DataFrame, anchors: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, doc_id, n_words, terms, positions, contexts) of every document, written out."""
    filters = tuple(_filter_of(anchors.filter(F.col("rank") == r)) for r in (1, 2))
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    return materialize(
        map_batches(
            docs,
            partial(_postings, window=window, anchors=shared),
            "key long, doc_id long, n_words long, terms array<long>, positions array<long>, contexts array<binary>",
        ),
        "index",
    )


def _candidates(batches: Batches, window: int, lengths: list[int], shared: Broadcast) -> Batches:
    """Places around the postings with a context where the words may be a window, with these words.

    A posting has one place for each offset that its word can have in a window of each length; a
    filter of all windows' hashes is asked, so nearly all that leaves a task is a match.
    """
    for rows in batches:
        terms = rows.column("terms")
        counts = np.diff(terms.offsets.to_numpy())
        contexts = rows.column("contexts").flatten()
        has = np.flatnonzero(pc.binary_length(contexts).to_numpy() > 0)
        if not len(has):
            continue
        around = np.frombuffer(b"".join(contexts.take(pa.array(has)).to_pylist()), np.uint64).reshape(len(has), -1)
        position = rows.column("positions").flatten().to_numpy()[has]
        key = np.repeat(rows.column("key").to_numpy(), counts)[has]
        for length in lengths:
            for offset in range(length):
                there = around[:, window - 1 - offset : window - 1 - offset + length]
                found = np.flatnonzero(passes(shared.value, _prints(there)) & (there != 0).all(axis=1))
                if len(found):
                    yield batch(
                        key=longs(key[found]),
                        window=longs(_prints(there[found])),
                        start=longs(position[found] - offset),
                        offset=pa.array(np.full(len(found), offset, np.int32)),
                        there=binaries(list(there[found])),
                    )


def exact_matches(index: DataFrame, anchors: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, window, start, length, exact): places where windows occur in the indexed documents.

    The lists of the rarest words are compared with the windows where they are stored, and what is
    left is intersected with the lists of the second rarest words, of the documents in question only:
    the rows that are shuffled follow the matches, however common the words are.
    """
    spark = index.sparkSession
    first = anchors.filter("rank = 1").select("window", "terms", "length", "offset")
    lengths = sorted(r["length"] for r in first.select("length").distinct().collect())
    filled = spark.sparkContext.broadcast(bloom_filter(first.select("window"), first.count()))
    postings = index.select("key", "terms", "positions", "contexts").filter(F.size("terms") > 0)
    found = map_batches(
        postings,
        partial(_candidates, window=window, lengths=lengths, shared=filled),
        "key long, window long, start long, offset int, there binary",
    )
    same = found.join(first, ["window", "offset"]).filter(F.col("there") == F.col("terms"))
    same = materialize(same.select("key", "window", "start", "length").distinct(), "candidates")
    keys = few(same.filter("length > 1").select("key").distinct())
    second = anchors.filter("rank = 2").select("window", "term", "offset")
    lists = index.select("key", "terms", "positions").join(keys, "key", "left_semi")
    lists = lists.select("key", F.explode(F.arrays_zip("terms", "positions")).alias("p"))
    lists = lists.select("key", F.col("p.terms").alias("term"), F.col("p.positions").alias("position")).distinct()
    # The windows found in a document tell which of its second lists are asked for.
    asked = same.filter("length > 1").join(second, "window")
    both = asked.join(
        lists.withColumnRenamed("key", "at"),
        (F.col("key") == F.col("at")) & (asked["term"] == lists["term"]) & (F.col("position") == F.col("start") + F.col("offset")),
        "left_semi",
    )
    exact = both.select("key", "window", "start", "length").union(same.filter("length = 1"))
    return exact.distinct().withColumn("exact", F.lit(True))


def phrase_matches(index: DataFrame, anchors: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """(key, window, start, length, exact): places where windows occur in the indexed documents.

    With ``slack`` 0 only exact matches. Else also places where the window's two rarest words stand
    at most that many words farther from each other, or nearer, than in the window.
    """
    if not slack:
        return exact_matches(index, anchors, window)
    postings = index.select("key", F.explode(F.arrays_zip("terms", "positions", "contexts")).alias("p")).select(
        "key", F.col("p.terms").alias("term"), F.col("p.positions").alias("position"), F.col("p.contexts").alias("context")
    )
    placed = postings.join(anchors, "term").select(
        "key", "window", "length", "terms", "rank", (F.col("position") - F.col("offset")).alias("start"),
        F.substring("context", F.lit(8) * (F.lit(window - 1) - F.col("offset")) + 1, F.lit(8) * F.col("length")).alias("there"),
    )
    rarest = placed.filter("rank = 1").withColumn("exact", F.col("there") == F.col("terms"))
    second = placed.filter("rank = 2").select("key", "window", F.col("start").alias("other"))
    rarest = rarest.select("key", "window", "start", "length", "exact")
    near = F.explode(F.sequence(F.floor(F.col("other") / slack) - 1, F.floor(F.col("other") / slack) + 1))
    second = second.withColumn("cell", near)
    joined = rarest.withColumn("cell", F.floor(F.col("start") / slack)).join(second, ["key", "window", "cell"])
    close = joined.filter(F.abs(F.col("start") - F.col("other")) <= slack).select(rarest.columns)
    return close.union(rarest.filter("length = 1")).distinct()


def few(keys: DataFrame) -> DataFrame:
    """The rows, written; marked for a broadcast if they are counted to be at most ``BROADCAST_KEYS``."""
    keys = materialize(keys, "keys")
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): key, doc_id, n_words, spans, items.

    ``spans`` are the (start, length) of all exact matches, ``items`` the sorted ids, as strings, of
    the items they come from; both null if there are none. Words are runs of 0-9, a-z (A-Z as a-z)
    and everything beyond ASCII. A null or empty text has no words; neither has it windows as an
    item. Items of fewer words than a window are one window; repeated items and rows count once per
    id. Null item ids match but are not listed. Other columns are ignored.
    """
    docs = with_key(docs)
    windows = benchmark_windows(benchmark, window)
    anchors = _anchors(docs, windows)
    index = positional_index(docs, anchors, window)
    matches = materialize(phrase_matches(index, anchors, window), "matches")
    spans = matches.groupBy("key").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    named = matches.select("key", "window").distinct().join(
        windows.select("window", F.col("item_id").cast("string").alias("item_id")).distinct(), "window"
    )
    items = named.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return index.select("key", "doc_id", "n_words").join(spans.join(items, "key"), "key", "left")


def clean_of(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with all their columns."""
    key = unused("hit_key", docs.columns)
    hit = contamination(docs.select("doc_id", "text"), benchmark, window).filter("spans IS NOT NULL")
    hit = few(hit.select(F.col("key").alias(key)).distinct())
    return docs.join(hit, F.xxhash64("doc_id", "text") == F.col(key), "left_anti")
