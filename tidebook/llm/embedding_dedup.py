"""Near duplicates among embeddings: random-hyperplane sign hashing, exact check, components.

1. Equal vectors form one class (a node), told by a 128-bit hash.
2. A node gets a signature in each of several tables: the signs of its products with random
   hyperplanes. Two vectors at an angle a agree in one sign with probability 1 - a/pi, so the number
   of signs is chosen by the number of nodes (about ``BUCKET_ROWS`` unrelated nodes to a bucket), and
   the number of tables by the recall wanted for a pair that is just similar enough.
3. Nodes of one bucket are compared exactly, block by block, in double precision. Links are counted
   for both ends at once; a pair that met in an earlier table already, told from the signatures that
   travel with the vectors, does not count again. A block sends a count for each node and the edges
   of a spanning forest, never its pairs.
4. Buckets of more than ``GROUP`` nodes are cut by hash into groups, and each pair of groups is a
   block of its own in any task, so no task holds more than two groups of a bucket.
5. Components of the forests' edges, by alternating stars.
"""

from __future__ import annotations

import math
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, binaries, longs, map_batches, whole_groups
from tidebook.llm.components import components
from tidebook.session import materialize

LEAST_COSINE = 0.95
RECALL = 0.99
BUCKET_ROWS = 16
GROUP = 1024
SEED = 20_011
MOST_BITS = 30
# Above so many crowded buckets they are joined by a shuffle of the vectors instead of a broadcast.
BROADCAST_ROWS = 1_000_000


def linkable(column: str | Column) -> Column:
    """Whether a vector is given, finite in all entries, and not zero."""
    c = F.col(column) if isinstance(column, str) else column
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(c, lambda x: x != 0), F.lit(False))


def table_sizes(n: int, least: float = LEAST_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Signs in a signature and number of tables for n nodes."""
    bits = min(MOST_BITS, max(4, math.ceil(math.log2(max(n, 1) / BUCKET_ROWS))) if n > BUCKET_ROWS else 4)
    agree = (1 - math.acos(least) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


@lru_cache(maxsize=4)
def hyperplanes(dims: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dims]).standard_normal((dims, tables * bits))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, in double precision; scaled first, so that no square overflows."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _signed(batches: Batches, bits: int, tables: int, kind: str) -> Batches:
    """Per node: its vector as bytes and its signature in every table."""
    powers = (1 << np.arange(bits)).astype(np.int64)
    for rows in batches:
        column = rows.column("vector")
        sizes = np.diff(column.offsets.to_numpy())
        values = column.flatten().to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        signatures = np.empty((rows.num_rows, tables), np.int64)
        for dims in np.unique(sizes):
            of = np.flatnonzero(sizes == dims)
            vectors = _unit(values[edges[of][:, None] + np.arange(dims)])
            signs = vectors @ hyperplanes(int(dims), bits, tables) > 0
            signatures[of] = signs.reshape(len(of), tables, bits) @ powers
        blobs = [values[a:b].astype(kind) for a, b in zip(edges[:-1], edges[1:])]
        yield batch(
            node=rows.column("node"),
            size=rows.column("size"),
            dims=longs(sizes),
            vector=binaries(blobs),
            signatures=pa.FixedSizeListArray.from_arrays(longs(signatures.ravel()), tables).cast(pa.list_(pa.int64())),
        )


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (root, member) of a spanning forest of a graph given by its symmetric matrix."""
    open_, roots, members = linked.any(axis=1), [], []
    while open_.any():
        root = int(open_.argmax())
        reached = np.zeros(len(linked), bool)
        front = np.zeros(len(linked), bool)
        front[root] = reached[root] = True
        while front.any():
            front = linked[front].any(axis=0) & ~reached
            reached |= front
        open_ &= ~reached
        found = np.flatnonzero(reached)
        members.append(found[found != root])
        roots.append(np.full(len(found) - 1, root))
    return (np.concatenate(roots), np.concatenate(members)) if roots else (np.empty(0, int), np.empty(0, int))


def _links(vectors: np.ndarray, signatures: np.ndarray, sides: np.ndarray, table: int, least: float) -> np.ndarray:
    """Which pairs of a block's rows are linked and first meet in this table. A block of two groups
    holds the pairs between them, a block of one group all its pairs."""
    linked = vectors @ vectors.T >= least
    linked &= signatures[:, table][:, None] == signatures[:, table][None, :]
    linked |= linked.T
    if sides.min() != sides.max():
        linked &= sides[:, None] != sides[None, :]
    np.fill_diagonal(linked, False)
    if linked.any():
        for earlier in range(table):
            linked &= signatures[:, earlier][:, None] != signatures[:, earlier][None, :]
    return linked


def _blocks(batches: Batches, least: float, kind: str) -> Batches:
    """Per block and node with links there: how many rows it is linked with, and its tree's root."""
    keys = ("spot", "place", "signature", "dims", "left", "right")
    for rows in whole_groups(batches, "spot"):
        columns = [rows.column(c).to_numpy() for c in keys]
        changes = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        edges = np.concatenate([[0], np.flatnonzero(changes) + 1, [rows.num_rows]])
        node, size, side = (rows.column(c).to_numpy() for c in ("node", "size", "side"))
        blobs = rows.column("vector")
        flat = rows.column("signatures").flatten().to_numpy()
        signatures = flat.reshape(rows.num_rows, -1)
        out: list[tuple[np.ndarray, ...]] = []
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a < 2 or columns[4][a] != columns[5][a] and side[a:b].min() == side[a:b].max():
                continue
            vectors = _unit(np.stack([np.frombuffer(x.as_buffer(), kind) for x in blobs[a:b]]))
            linked = _links(vectors, signatures[a:b], side[a:b], int(columns[1][a]), least)
            counts = linked @ size[a:b]
            roots, members = _forest(linked)
            root = node[a:b].copy()
            root[members] = node[a:b][roots]
            has = np.flatnonzero(counts)
            out.append((node[a:b][has], counts[has], root[has]))
        if out:
            yield batch(**{name: longs(np.concatenate([o[i] for o in out])) for i, name in enumerate(("node", "links", "root"))})


def _classes(rows: DataFrame, key: str, column: str) -> DataFrame:
    """Rows whose vectors can be linked, in classes of equal vectors: h1, h2, vector, size, first."""
    vector = F.col(column)
    hashed = rows.filter(linkable(column)).select(
        F.col(key).alias("id"), vector.alias("vector"), F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(SEED), vector).alias("h2")
    )
    classes = hashed.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.count("*").alias("size"), F.min("id").alias("first"))
    return materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")


def _dealt(signed: DataFrame) -> DataFrame:
    """Nodes by block: a row for each table, and for large buckets one for each pair of groups that
    the node's group is in."""
    entries = signed.select("node", "dims", F.posexplode("signatures").alias("place", "signature"))
    crowded = entries.groupBy("place", "signature", "dims").count().filter(F.col("count") > GROUP)
    groups = crowded.select("place", "signature", "dims", F.ceil(F.col("count") / GROUP).cast("int").alias("groups"))
    groups = materialize(groups, "crowded")
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    every = signed.select("*", F.posexplode("signatures").alias("place", "signature"))
    every = every.join(groups, ["place", "signature", "dims"], "left")
    side = F.coalesce(F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"), F.lit(0))
    others = F.sequence(F.lit(0), F.coalesce(F.col("groups"), F.lit(1)) - 1)
    every = every.withColumn("side", side).withColumn("other", F.explode(others))
    every = every.withColumn("left", F.least("side", "other")).withColumn("right", F.greatest("side", "other"))
    every = every.withColumn("spot", F.xxhash64("place", "signature", "dims", "left", "right")).drop("groups", "other")
    return every.repartition("spot").sortWithinPartitions("spot", "place", "signature", "dims", "left", "right")


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", column: str = "embedding", least: float = LEAST_COSINE, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``rows``: key, n_links, component_id, kept.

    ``n_links`` counts the other rows found with a cosine of at least ``least``; no link below it is
    ever counted, and one exactly as similar is missed with a probability of 1 - ``recall`` at most
    (closer ones, far more rarely). ``component_id`` is the smallest key that links reach; ``kept``
    says whether it is the row's own. Vectors that are null, empty or zero, or hold a null or
    non-finite entry, link with nothing, and so do vectors of different lengths. Equal vectors and
    repeated rows are linked rows of their own; rows with the smallest key are all kept. A null key
    is the smallest only where all keys reached are null. Other columns are ignored. An empty table
    gives no rows.
    """
    rows = rows.select(F.col(key).alias(key), F.col(column).alias(column))
    kind = {"float": "float32", "double": "float64"}[rows.schema[column].dataType.elementType.typeName()]
    classes = _classes(rows, key, column)
    bits, tables = table_sizes(classes.count(), least, recall)
    signed = materialize(
        map_batches(
            classes.select("node", "size", "vector"),
            partial(_signed, bits=bits, tables=tables, kind=kind),
            "node long, size long, dims long, vector binary, signatures array<long>",
        ),
        "signed",
    )
    found = map_batches(_dealt(signed), partial(_blocks, least=least, kind=kind), "node long, links long, root long")
    found = materialize(found, "links")
    groups = components(found.select(F.col("root").alias("u"), F.col("node").alias("v")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = classes.drop("vector").join(counts, "node", "left").join(groups, "node", "left")
    resolved = materialize(joined.withColumn("component", F.coalesce("component", "node")), "resolved")
    smallest = resolved.groupBy("component").agg(F.min("first").alias("component_id"))
    resolved = resolved.join(smallest, "component").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"
    )
    good = rows.filter(linkable(column)).select(
        key, F.xxhash64(F.col(column)).alias("h1"), F.xxhash64(F.lit(SEED), F.col(column)).alias("h2")
    )
    own = F.col(key).eqNullSafe(F.col("component_id"))
    linked = good.join(resolved, ["h1", "h2"]).select(key, "n_links", "component_id", own.alias("kept"))
    rest = rows.filter(~linkable(column))
    return linked.unionByName(
        rest.select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    )
