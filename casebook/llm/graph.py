"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised

MAX_ROUNDS = 60


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from every node.

    ``nodes`` has ``node`` (distinct), ``edges`` has ``a`` and ``b`` of one type.
    Each round sends every node's larger neighbours, then the smaller ones, to
    its smallest neighbour; rounds stop when the edge set no longer changes.
    Edges stay within the number of input edges, and each round is written to
    the shared checkpoint folder.
    """
    both = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialised(edges.filter("a != b").select(both.alias("e")).select("e.*").distinct())
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        # large star: every neighbour above u goes to the smallest around u
        around = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(
            F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u != v").distinct()
        following = materialised(small)
        after = _state(following)
        now, done, state = following, after == state, after
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
