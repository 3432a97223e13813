"""N-gram Jaccard join with signature trees: groups of documents whose word shingles overlap.

Exact: two documents are linked when their shingle sets have a Jaccard similarity of at least the
threshold, and every document gets the smallest id that links reach.

1. Documents with equal sets form one class (a node).
2. Shingles are counted over all documents in 2**32 hashed slots, and ordered by frequency, the
   rare ones first; bitmaps of a fixed size tell the levels. With any common order, two sets of
   similarity s share one of their first size - ceil(s * size) + 1 shingles, so a node is entered
   in the blocks of these shingles only, and not of those found once. Blocks hold nodes that share
   something rare.
3. In a block, nodes sorted by size are packed into leaves. First only each leaf's first node is
   compared with the rest of the leaf and with the next leaf; these few pairs connect the copies.
4. Blocks that still hold several components get a signature tree: every tree node has the union
   of its members' bitmaps and their range of sizes, and a dual traversal drops pairs of tree
   nodes that lie in one component or cannot overlap enough. What is left is compared exactly.
   The block of the first shingle that two sets share finds them, so the shingles from there on
   (``rest``) bound their overlap too.
5. A block of more than ``GROUP`` nodes is cut by size and, where a component is large, by component.
   Pairs of these groups that can hold a link are dealt over tasks, each with a tree of its own.

No group is expanded into all its pairs: members that are already connected are skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, binaries, longs, map_batches, run_starts, unused, whole_groups
from tidebook.llm.components import components
from tidebook.llm.words import LOWER_WORDS, Words, grams, mix, slices, words_of
from tidebook.session import materialize

WORDS = 5
PERCENT = 80
LEAF = 16
# Frequency levels: bitmaps of 2**26 bits (8 MB), each for counts eight times as high as the last.
FOLD = 64
LEVELS = 4
LEVEL_STEP = 8
THRESHOLDS = tuple(1 << k for k in range(1, 31))
FULLEST = 0.3
BUCKETS = 1024
# Rows of a block that are handled together; larger blocks are cut. ``BANDS`` bands of sizes span the
# ratio of sizes that can be linked.
GROUP = 2_048
BANDS = 8
# Rows of related blocks in one task, and pairs that it holds back to make them unique.
SHARE = 4_096
HELD_PAIRS = 1_000_000
# Above so many ids, documents are found again by a shuffle instead of a broadcast.
BROADCAST_IDS = 1_000_000


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, one after the other, and their offsets.

    A text of fewer than n words has its whole sequence as one shingle; one without words has none.
    """
    counts = np.diff(words.offsets)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    long_enough = counts >= n
    out = np.empty(ends[-1], np.uint64)
    if len(words.hashes) >= n:
        runs = grams(words.hashes, n)
        inside = np.repeat(words.offsets[:-1], sizes) + np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
        whole = np.repeat(long_enough, sizes)
        out[whole] = runs[inside[whole]]
    for i in np.flatnonzero(~long_enough & (counts > 0)):
        out[ends[i]] = grams(words.of(i), int(counts[i]))[0] ^ mix(counts[i : i + 1].astype(np.uint64))[0]
    for a, b in zip(ends[:-1][sizes > 1], ends[1:][sizes > 1]):
        out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[ends[:-1][sizes > 0]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[ends]


# Counts of shingles in hashed slots


def _slots(batches: Batches, n: int) -> Batches:
    edges = (np.arange(1, BUCKETS, dtype=np.uint64) * np.uint64((1 << 32) // BUCKETS)).astype(np.uint32)
    for rows in slices(batches, "text"):
        hashes, _ = shingle_sets(words_of(rows.column("text"), LOWER_WORDS), n)
        slots = np.sort((hashes >> np.uint64(32)).astype(np.uint32))
        parts = np.split(slots, np.searchsorted(slots, edges))
        full = [i for i, p in enumerate(parts) if len(p)]
        yield batch(bucket=pa.array(full, pa.int32()), slots=binaries([parts[i] for i in full]))


def _counted(batches: Batches) -> Batches:
    """Per bucket and threshold, which groups of ``FOLD`` slots have a slot of such a count.

    Rows come by bucket; one bucket's counters are held at a time.
    """
    width = (1 << 32) // BUCKETS
    counts = np.zeros(width, np.uint32)
    for bucket, blobs in _by_bucket(batches):
        counts[:] = 0
        for blob in blobs:
            found, times = np.unique(np.frombuffer(blob, np.uint32) - np.uint32(bucket * width), return_counts=True)
            counts[found] += times.astype(np.uint32)
        highest = counts.reshape(-1, FOLD).max(axis=1)
        levels = [t for t in THRESHOLDS if t <= highest.max()]
        yield batch(
            bucket=pa.array([bucket] * len(levels), pa.int32()),
            least=longs(np.array(levels, np.int64)),
            n=longs(np.array([(highest >= t).sum() for t in levels], np.int64)),
            bits=binaries([np.packbits(highest >= t, bitorder="little") for t in levels]),
        )


def _by_bucket(batches: Batches) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(bucket, its blobs) without holding a bucket's blobs in memory."""
    rows = (
        (bucket, blob)
        for part in batches
        for bucket, blob in zip(part.column("bucket").to_pylist(), part.column("slots").to_pylist())
    )
    for bucket, group in groupby(rows, key=lambda row: row[0]):
        yield bucket, (blob for _, blob in group)


@dataclass
class Levels:
    """Bitmaps by ascending frequency; ``least`` is the count that the first stands for."""

    least: int
    bitmaps: list[np.ndarray]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The level of every shingle. Level 0 with ``least`` 2: found in no other document."""
        at = (hashes >> np.uint64(32)).astype(np.int64) // FOLD
        level = np.zeros(len(hashes), np.uint8)
        for bitmap in self.bitmaps:
            level += (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return level


def frequency_levels(docs: DataFrame, n: int = WORDS) -> Levels:
    """Levels of all shingles of all documents. The first has the lowest threshold whose bitmap is
    not too full to tell anything; there are ``LEVELS`` at most, whatever the input's size."""
    counted = materialize(
        map_batches(
            map_batches(docs.select("text"), partial(_slots, n=n), "bucket int, slots binary")
            .repartition("bucket")
            .sortWithinPartitions("bucket"),
            _counted,
            "bucket int, least long, n long, bits binary",
        ),
        "levels",
    )
    used = {r.least: r.n for r in counted.groupBy("least").agg(F.sum("n").alias("n")).collect()}
    size = (1 << 32) // FOLD
    useful = sorted(t for t, n_set in used.items() if n_set <= FULLEST * size)
    chosen = [t for t in useful if t in {useful[0] * LEVEL_STEP**k for k in range(LEVELS)}]
    bitmaps = []
    for least in chosen:
        bitmap = np.zeros((BUCKETS, size // BUCKETS // 8), np.uint8)
        for r in counted.filter(F.col("least") == least).select("bucket", "bits").toLocalIterator():
            bitmap[r.bucket] = np.frombuffer(r.bits, np.uint8)
        bitmaps.append(bitmap.ravel())
    return Levels(chosen[0] if chosen else 2, bitmaps)


# Nodes and their first shingles


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap with which sets of sizes a and b are linked."""
    return -(-percent * (a + b) // (100 + percent))


def _signed(batches: Batches, n: int, percent: int, shared: Broadcast) -> Batches:
    """Per document: size, fingerprint of the set, and its first shingles in the common order.

    Shingles known to be in no other document are left out: they come first and are in no block.
    ``skipped`` is their number.
    A set that this task has entered before gets no second entry.
    """
    levels: Levels = shared.value
    entered: set[int] = set()
    for rows in slices(batches, "text"):
        hashes, ends = shingle_sets(words_of(rows.column("text"), LOWER_WORDS), n)
        level = levels.of(hashes)
        sizes = np.diff(ends)
        firsts, nodes, skipped = [], np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.int64)
        sums = _set_prints(hashes, ends)
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            nodes[i] = sums[i]
            if a == b or int(nodes[i]) in entered:
                firsts.append(hashes[:0])
                continue
            entered.add(int(nodes[i]))
            count = (b - a) - -(-percent * (b - a) // 100) + 1
            alone = int((level[a:b] == 0).sum()) if levels.least == 2 else 0
            if alone >= count:
                firsts.append(hashes[:0])
                continue
            skipped[i] = alone
            order = np.argsort(level[a:b], kind="stable")
            firsts.append(hashes[a:b][order[alone:count]])
        lengths = np.array([len(f) for f in firsts])
        flat = np.concatenate(firsts) if firsts else hashes[:0]
        yield batch(
            doc_id=rows.column("doc_id"),
            key=rows.column("key"),
            n_shingles=longs(sizes),
            node=longs(nodes),
            skipped=longs(skipped),
            firsts=pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), longs(flat)
            ),
        )


def _set_prints(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A fingerprint of every set: an order-free sum of spread hashes, spread again with the size."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return mix((sums[ends[1:]] - sums[ends[:-1]]) ^ mix(np.diff(ends).astype(np.uint64)))


def _blocks(signed: DataFrame) -> DataFrame:
    """Blocks of two nodes or more: (token, node, n_shingles, rest, n_members).

    Of blocks with the same members only that of the first token in the common order stays, which
    is the one with the lowest places in all of them.
    """
    entries = signed.select("node", "n_shingles", "skipped", F.posexplode("firsts").alias("at", "token"))
    entries = entries.select("token", "node", "n_shingles", (F.col("skipped") + F.col("at")).alias("place")).distinct()
    entries = materialize(entries, "entries")
    members = entries.groupBy("token").agg(
        F.count("*").alias("n_members"),
        F.bit_xor(F.xxhash64("node")).alias("a"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("b"),
        F.sum("place").alias("places"),
    )
    alike = members.filter("n_members > 1").groupBy("n_members", "a", "b")
    chosen = alike.agg(F.min(F.struct("places", "token")).alias("first")).select("first.token", "n_members")
    rest = (F.col("n_shingles") - F.col("place")).alias("rest")
    return materialize(entries.join(chosen, "token").select("token", "node", "n_shingles", rest, "n_members"), "blocks")


# Sets of the nodes that are in blocks, and pairs of them


def _bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bits of the shingles in a bitmap of 8 to 16 times as many bits, 64 at least."""
    bits = 1 << max(6, int(len(shingles) * 8 - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(shingles % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little")


def _sets(batches: Batches, n: int) -> Batches:
    for rows in slices(batches, "text"):
        hashes, ends = shingle_sets(words_of(rows.column("text"), LOWER_WORDS), n)
        nodes = _set_prints(hashes, ends)
        sets = [hashes[a:b] for a, b in zip(ends[:-1], ends[1:])]
        yield batch(node=longs(nodes), shingles=binaries(sets), bitmap=binaries([_bitmap(s) for s in sets]))


def _chains(batches: Batches, percent: int) -> Batches:
    """Pairs that link a cell along its leaves. Rows sorted by cell, size, node."""
    for rows in whole_groups(batches, "cell"):
        cell, node, size = (rows.column(c).to_numpy() for c in ("cell", "node", "n_shingles"))
        starts = run_starts(cell)
        first = np.repeat(starts, np.diff(np.concatenate([starts, [len(cell)]])))
        place = np.arange(len(cell))
        leaf = first + (place - first) // LEAF * LEAF
        other = np.where(place == leaf, np.maximum(leaf - LEAF, first), leaf)
        near = (other != place) & (100 * size[other] >= percent * size)
        yield _pairs(node[other[near]], node[place[near]])


def _near(blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs that connect most copies. A large block is dealt over cells by hash, and the first nodes
    of its cells are paired with the block's first."""
    cells = F.ceil(F.col("n_members") / GROUP)
    dealt = blocks.withColumn("cell", F.xxhash64("token", F.pmod(F.xxhash64("node"), cells)))
    rows = dealt.select("cell", "n_shingles", "node").repartition("cell").sortWithinPartitions("cell", "n_shingles", "node")
    chained = map_batches(rows, partial(_chains, percent=percent), "u long, v long")
    firsts = dealt.filter(F.col("n_members") > GROUP).groupBy("token", "cell").agg(F.min("node").alias("node"))
    lead = firsts.groupBy("token").agg(F.min("node").alias("u"))
    return chained.union(firsts.join(lead, "token").filter("u < node").select("u", F.col("node").alias("v")))


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.empty((0, 2), np.int64)
    return batch(u=longs(found[:, 0]), v=longs(found[:, 1]))


def _linked(batches: Batches, percent: int) -> Batches:
    """The pairs whose sets overlap enough."""
    for rows in batches:
        good = []
        for a, b in zip(rows.column("a").to_pylist(), rows.column("b").to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(a) + len(b) - len(np.union1d(a, b))
            good.append(100 * both >= percent * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([rows.column("u"), rows.column("v")], ["u", "v"]).filter(pa.array(good, pa.bool_()))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    joined = pairs.distinct().join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return materialize(map_batches(joined, partial(_linked, percent=percent), "u long, v long"), "links")


# Signature trees


class _Tree:
    """Levels of nodes over members sorted by side and size; level 0 holds the members themselves.

    ``rests`` bounds the overlap of every member. With two ``sides``, only pairs across them count.
    """

    def __init__(
        self,
        sizes: np.ndarray,
        parts: np.ndarray,
        maps: np.ndarray,
        rests: np.ndarray | None = None,
        sides: np.ndarray | None = None,
    ):
        bits = np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        sides = np.zeros(len(sizes), np.int64) if sides is None else sides
        self.across = bool(len(sides)) and sides[0] != sides[-1]
        level = {
            "low": sizes, "high": sizes, "part_low": parts, "part_high": parts, "side_low": sides, "side_high": sides,
            "spare": sizes - bits, "rest": sizes if rests is None else rests, "maps": maps,
        }
        merge = {"low": np.minimum, "part_low": np.minimum, "side_low": np.minimum, "maps": np.bitwise_or}
        self.levels = [level]
        while len(level["low"]) > 1:
            at = np.arange(0, len(level["low"]), LEAF)
            level = {name: merge.get(name, np.maximum).reduceat(values, at, axis=0) for name, values in level.items()}
            self.levels.append(level)

    def survivors(self, depth: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of nodes (a before b) can hold a link between two components.

        Shingles that share no bit are different, so an overlap is at most the common bits plus
        the shingles that a set has beyond its bits; and at most what either set has left.
        """
        x = self.levels[depth]

        def differ(name: str) -> np.ndarray:
            low, high = x[name + "_low"], x[name + "_high"]
            return (low[a] != low[b]) | (high[a] != high[b]) | (low[a] != high[a])

        needed = _needed(x["low"][a], x["low"][b], percent)
        fit = differ("part") & (100 * x["high"][a] >= percent * x["low"][b])
        fit &= np.minimum(x["rest"][a], x["rest"][b]) >= needed
        if self.across:
            fit &= differ("side")
        keep = np.flatnonzero(fit)
        a, b = a[keep], b[keep]
        shared = np.empty(len(a), np.int64)
        for i in range(0, len(a), 4096):
            common = x["maps"][a[i : i + 4096]] & x["maps"][b[i : i + 4096]]
            shared[i : i + 4096] = np.bitwise_count(common).sum(axis=1)
        most = shared + np.minimum(x["spare"][a], x["spare"][b])
        return keep[most >= needed[keep]]

    def _below(self, depth: int, a: np.ndarray, b: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The surviving children of pairs of nodes, some pairs at a time."""
        n = len(self.levels[depth]["low"])
        for i in range(0, len(a), 1024):
            x = (a[i : i + 1024, None, None] * LEAF + np.arange(LEAF)[None, :, None]) + np.zeros((1, 1, LEAF), np.int64)
            y = (b[i : i + 1024, None, None] * LEAF + np.arange(LEAF)[None, None, :]) + np.zeros((1, LEAF, 1), np.int64)
            x, y = x.ravel(), y.ravel()
            fit = (x < n) & (y < n) & ((x < y) | ((x == y) & (depth > 0)))
            x, y = x[fit], y[fit]
            keep = self.survivors(depth, x, y, percent)
            yield x[keep], y[keep]

    def chunks(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Dual traversal from the root to pairs of members, which come in chunks."""
        a = b = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 2, 0, -1):
            a, b = (np.concatenate(x) for x in zip(*self._below(depth, a, b, percent)))
            if not len(a):
                return
        if len(self.levels) > 1:
            yield from self._below(0, a, b, percent)

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """All chunks together."""
        none = np.empty(0, np.int64)
        a, b = zip((none, none), *self.chunks(percent))
        return np.concatenate(a), np.concatenate(b)


def _folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps of different widths, folded to the narrowest (widths are powers of two)."""
    width = min(map(len, maps))
    out = np.empty((len(maps), width), np.uint8)
    for i, m in enumerate(maps):
        out[i] = np.bitwise_or.reduce(np.frombuffer(m, np.uint8).reshape(-1, width), axis=0)
    return out.view(np.uint64)


def _crossing(batches: Batches, percent: int) -> Batches:
    """Pairs across components that the trees of the cells cannot rule out. Rows sorted by cell, side.

    Blocks of the same documents find the same pairs, so pairs are made unique before they leave.
    """
    found: list[np.ndarray] = []
    n = 0
    for rows in whole_groups(batches, "cell"):
        cell, side, node, size, rest, part = (
            rows.column(c).to_numpy() for c in ("cell", "side", "node", "n_shingles", "rest", "part")
        )
        maps = rows.column("bitmap").to_pylist()
        edges = np.concatenate([run_starts(cell), [len(cell)]])
        for a, b in zip(edges[:-1], edges[1:]):
            tree = _Tree(size[a:b], part[a:b], _folded(maps[a:b]), rest[a:b], side[a:b])
            for x, y in tree.chunks(percent):
                u, v = node[a:b][x], node[a:b][y]
                found.append(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1))
                n += len(u)
                if n >= HELD_PAIRS:
                    found = [np.unique(np.concatenate(found), axis=0)]
                    if len(found[0]) >= HELD_PAIRS // 2:
                        yield _pairs(found[0][:, 0], found[0][:, 1])
                        found = []
                    n = sum(map(len, found))
    if found:
        every = np.concatenate(found)
        yield _pairs(every[:, 0], every[:, 1])


def _grouped(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of large blocks with the band of their size and their group.

    Groups have about ``GROUP`` rows. A component with as many in a band has groups of its own, so
    that they need not be compared with each other.
    """
    step = math.log(100 / percent) * 1.0001 / BANDS if percent < 100 else 1e-9
    rows = rows.withColumn("band", F.floor(F.log("n_shingles") / step))
    counted = rows.groupBy("token", "band", "part").agg(F.count("*").alias("n"))
    counted = counted.withColumn("own", F.when(F.col("n") >= GROUP, F.col("part")))
    others = counted.filter("own IS NULL").groupBy("token", "band").agg(F.ceil(F.sum("n") / GROUP).alias("n_others"))
    own = counted.filter("own IS NOT NULL").select("token", "band", "part", "own", F.ceil(F.col("n") / GROUP).alias("n_own"))
    known = rows.join(own, ["token", "band", "part"], "left").join(others, ["token", "band"], "left")
    share = F.pmod(F.xxhash64("node", F.lit(2)), F.coalesce("n_own", "n_others"))
    group = F.xxhash64("token", "band", F.col("own").isNull(), F.coalesce("own", F.lit(0)), share)
    return known.withColumn("group", group).select("token", "node", "n_shingles", "rest", "part", "band", "group")


def _group_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(cell, group, side) of the pairs of groups that can hold a link; of a group with itself once."""
    groups = rows.groupBy("token", "band", "group").agg(
        F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"), F.max("rest").alias("rest"),
        F.min("part").alias("part_low"), F.max("part").alias("part_high"),
    )
    groups = materialize(groups, "groups")
    above = F.explode(F.sequence("band", F.col("band") + BANDS))
    a = groups.select("token", above.alias("band"), F.col("band").alias("own_band"), *[F.col(c).alias(c + "_a") for c in groups.columns[2:]])
    both = a.join(groups, ["token", "band"])
    needed = F.ceil(percent * (F.col("low_a") + F.col("low")) / (100 + percent))
    one_part = (F.col("part_low_a") == F.col("part_high_a")) & (F.col("part_low") == F.col("part_high")) & (F.col("part_low_a") == F.col("part_low"))
    able = (
        ((F.col("own_band") < F.col("band")) | (F.col("group_a") <= F.col("group")))
        & ~one_part
        & (100 * F.col("high_a") >= percent * F.col("low"))
        & (F.least("rest_a", "rest") >= needed)
    )

    def placed(side: int, group: Column) -> Column:
        return F.struct(group.alias("group"), F.lit(side).alias("side"))

    first, second = placed(0, F.col("group_a")), placed(1, F.col("group"))
    sides = F.when(F.col("group_a") == F.col("group"), F.array(first)).otherwise(F.array(first, second))
    return both.filter(able).select(F.xxhash64("group_a", "group").alias("cell"), F.inline(sides))


def _open_blocks(blocks: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Cells of blocks with several components: (cell, side, node, n_shingles, rest, part, bitmap),
    sorted by cell, side and size. A cell is a block, or a pair of groups of a large one. Blocks with
    the same first component go to one task, up to ``SHARE`` rows a task."""
    parted = blocks.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = parted.groupBy("token").agg(F.min("part").alias("lead"), F.max("part").alias("last"), F.count("*").alias("n"))
    mixed = mixed.filter("lead <> last")
    shares = mixed.filter(F.col("n") <= GROUP).groupBy("lead").agg(F.ceil(F.sum("n") / SHARE).alias("shares"))
    placed = mixed.join(shares, "lead", "left").select("token", "lead", "shares")
    opened = materialize(parted.join(placed, "token"), "opened")
    columns = ["deal", "cell", "side", "node", "n_shingles", "rest", "part"]
    small = opened.filter(F.col("n_members") <= GROUP)
    small = small.withColumn("deal", F.xxhash64("lead", F.pmod("token", "shares"))).withColumn("cell", F.col("token")).withColumn("side", F.lit(0))
    grouped = _grouped(opened.filter(F.col("n_members") > GROUP), percent)
    grouped = materialize(grouped, "grouped")
    large = grouped.join(_group_pairs(grouped, percent), "group").withColumn("deal", F.col("cell"))
    rows = small.select(columns).union(large.select(columns)).join(sets.select("node", "bitmap"), "node")
    dealt = rows.repartition("deal").sortWithinPartitions("deal", "cell", "side", "n_shingles", "node")
    return dealt.select("cell", "side", "node", "n_shingles", "rest", "part", "bitmap")


def _placed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, key (of id and text), n_shingles, node, component."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    levels = spark.sparkContext.broadcast(frequency_levels(docs, n))
    signed = materialize(
        map_batches(
            docs,
            partial(_signed, n=n, percent=percent, shared=levels),
            "doc_id long, key long, n_shingles long, node long, skipped long, firsts array<long>",
        ),
        "signed",
    )
    blocks = _blocks(signed)
    sets = _needed_sets(docs, signed, blocks, n)
    links = _verify(_near(blocks, percent), sets, percent)
    parts = components(links).withColumnRenamed("component", "part")
    crossing = map_batches(_open_blocks(blocks, parts, sets, percent), partial(_crossing, percent=percent), "u long, v long")
    links = links.union(_verify(crossing, sets, percent))
    groups = components(links)
    placed = signed.select("doc_id", "key", "n_shingles", "node").join(groups, "node", "left")
    return placed.withColumn("component", F.coalesce("component", "node"))


def jaccard_components(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, node, component_id.

    ``node`` is the fingerprint of the shingle set. Words are runs without blanks, A-Z as a-z.
    A null text is empty; without words the set is empty, linked with nothing, and component_id is
    the document's own id. Repeated rows and equal ids count as documents of their own. A null id
    is never the smallest; it is returned only where all ids reached are null. Other columns are
    ignored. An empty table gives no rows.
    """
    placed = _placed(docs, n, percent)
    smallest = placed.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    alone = F.col("n_shingles") == 0
    return placed.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id")
    )


def _needed_sets(docs: DataFrame, signed: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """(node, shingles, bitmap) of every node that is in a block, from one of its documents."""
    nodes = blocks.select("node").distinct()
    wanted = materialize(
        signed.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "wanted"
    )
    ids = wanted.select("doc_id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.join(ids.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    found = map_batches(texts.select("text"), partial(_sets, n=n), "node long, shingles binary, bitmap binary")
    return materialize(found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")


def one_per_group(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies: of every group, the row with the smallest id.

    All columns are kept. Rows are told apart by id and text, so rows of one id may be in different
    groups; of several texts with the smallest id the one with the smallest hash stays. Documents
    without words stay. A group that has null ids only keeps one row; beside a named row, rows with
    a null id stay.
    """
    key = unused("row_key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    placed = _placed(docs, n, percent).filter("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    first = materialize(placed.groupBy("component").agg(F.min(order).alias("first")), "first")
    chosen = first.select(F.col("first.key").alias(key))
    beside = placed.filter("doc_id IS NULL").join(first.filter("NOT first.unnamed"), "component", "left_semi")
    wordless = docs.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    kept = keyed.join(chosen, key, "left_semi").dropDuplicates([key])
    unnamed = keyed.filter("doc_id IS NULL").join(beside.select(F.col("key").alias(key)), key, "left_semi")
    return kept.unionByName(unnamed).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(wordless)
