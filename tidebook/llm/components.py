"""Connected components of a graph of long node ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.session import materialize

MAX_ROUNDS = 60


def _nearest(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with the smallest node among u and its neighbours."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("low"))
    smallest = smallest.select("u", F.least("u", "low").alias("low"))
    return edges.join(smallest, "u")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")
    ).select("e.u", "e.v")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v); component is the smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones, under its smallest
    neighbour. Degrees shrink to stars in about log(n) rounds; minima are combined in every task
    before the shuffle, and AQE splits a hub in the joins. Every round is written out, so a lost
    executor never costs more than the round at hand. No edges: no rows. Loops are ignored.
    """
    state = materialize(edges.filter("u <> v").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        large = _nearest(_both(state)).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        hung = _nearest(down)
        small = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            hung.select("u", F.col("low").alias("v"))
        )
        state = materialize(small.filter("u <> v").distinct(), "edges")
        checks = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v")))
        now = tuple(checks.first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
