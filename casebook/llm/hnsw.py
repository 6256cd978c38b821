"""Nearest neighbours by one HNSW graph per shard, merged.

Index.  Vectors are dealt to shards by a hash of the vector; equal vectors meet
there and become one node that keeps its ``copies`` smallest ids (more can never
be asked for, as ties go to smaller ids).  Every shard is a task: nodes are inserted
into a navigable small-world graph with levels from a hash, ``links`` neighbours a
node (twice as many at the bottom) chosen by the diversity heuristic.  The graph
is stored as flat arrays: for every level the node numbers, offsets and neighbours.

Walks compare squared distances, summed from differences in double precision after an exact
scaling of the shard by a power of two, so vectors far from the origin, very large or very
small ones, and mixtures of them are told apart as on paper.

Search.  Queries are dealt to every shard in blocks (a stated query set against
all rows), walk each graph with a candidate list of ``width``, and the shards'
candidates are scored exactly in double precision on the original vectors, expanded
to ids, and ranked once per query.  The cost is queries times shards; a block holds more queries
than a shard has vectors, so the copies of the index for the blocks stay below
the queries that meet it.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows with a null id; repeated rows of one id and
vector are one candidate; an id with several vectors is a candidate with each and
ranks by its nearest; a query with fewer candidates gets all of them; an empty
table gives an empty result; extra columns are ignored.  Vectors of different
lengths are indexed apart, a query meets only those of its own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialised, prepare_workers

SHARD_ROWS = 4096
LINKS = 14
BUILD_WIDTH = 64
SEARCH_WIDTH = 120
#: Partitions per shard, so that few shards share one.
SPREAD = 4
#: Queries that one task takes to one shard.
QUERY_BLOCK = 8192

INDEX = "shard int, dim int, vectors binary, ids array<array<bigint>>, levels array<struct<nodes:binary,offsets:binary,neighbours:binary>>, entry int"


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component finite."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def scale_of(data: np.ndarray) -> int:
    """The power of two that brings the largest component of ``data`` to one half or more, and below one."""
    return -int(np.frexp(np.abs(data).max(initial=0.0))[1])


class Graph:
    """A navigable small world over the rows of ``data``."""

    def __init__(self, data: np.ndarray, tops: np.ndarray, links: int, build_width: int):
        self.data, self.tops, self.links, self.width = data, tops, links, build_width
        self.near: list[dict[int, np.ndarray]] = [{} for _ in range(int(tops.max()) + 1)] if len(data) else []
        self.entry = -1
        self.seen = np.zeros(len(data), np.int64)
        self.turn = 0
        for node in range(len(data)):
            self._insert(node)

    def distances(self, x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances."""
        gap = self.data[nodes] - x
        return np.einsum("ij,ij->i", gap, gap)

    def walk(self, x: np.ndarray, start: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest found at a level, nearest first."""
        near, seen = self.near[level], self.seen
        self.turn += 1
        turn = self.turn
        seen[[n for _, n in start]] = turn
        todo = list(start)
        heapq.heapify(todo)
        best = [(-d, n) for d, n in start]
        heapq.heapify(best)
        while todo:
            d, node = heapq.heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            fresh = near[node]
            fresh = fresh[seen[fresh] != turn]
            if not len(fresh):
                continue
            seen[fresh] = turn
            gap = self.data[fresh] - x
            far = np.einsum("ij,ij->i", gap, gap)
            if len(best) >= width:
                mask = far < -best[0][0]
                fresh, far = fresh[mask], far[mask]
            for d, n in zip(far.tolist(), fresh.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                else:
                    continue
                heapq.heappush(todo, (d, n))
        return sorted((-d, n) for d, n in best)

    def _diverse(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours nearer to the node than to one chosen before; filled up with the nearest."""
        nodes = np.fromiter((n for _, n in found), np.int64, len(found))
        if len(nodes) <= most:
            return nodes.tolist()
        own = np.fromiter((d for d, _ in found), np.float64, len(found))
        rows = self.data[nodes]
        chosen: list[int] = []
        blocked = np.zeros(len(nodes), bool)
        for i in range(len(nodes)):
            if blocked[i]:
                continue
            chosen.append(i)
            if len(chosen) >= most:
                break
            # j is blocked when i is nearer to j than the node itself is
            gap = rows - rows[i]
            blocked |= np.einsum("ij,ij->i", gap, gap) < own
        if len(chosen) < most:
            left = [i for i in range(len(nodes)) if i not in set(chosen)]
            chosen += left[: most - len(chosen)]
        return nodes[chosen].tolist()

    def _insert(self, node: int) -> None:
        x, top = self.data[node], int(self.tops[node])
        if self.entry < 0:
            self.entry = node
            for level in range(top + 1):
                self.near[level][node] = np.zeros(0, np.int64)
            return
        at = [(float(self.distances(x, np.array([self.entry]))[0]), self.entry)]
        highest = int(self.tops[self.entry])
        for level in range(highest, top, -1):
            at = self.walk(x, at[:1], 1, level)
        for level in range(min(top, highest), -1, -1):
            at = self.walk(x, at, self.width, level)
            most = self.links * (2 if level == 0 else 1)
            chosen = self._diverse(at, self.links)
            near = self.near[level]
            near[node] = np.array(chosen, np.int64)
            for other in chosen:
                around = np.append(near[other], node)
                if len(around) > most:
                    y = self.data[other]
                    far = self.distances(y, around)
                    order = np.argsort(far, kind="stable")
                    around = np.array(self._diverse(list(zip(
                        far[order].tolist(), around[order].tolist(), strict=True)), most), np.int64)
                near[other] = around
        for level in range(highest + 1, top + 1):
            self.near[level][node] = np.zeros(0, np.int64)
        if top > highest:
            self.entry = node

    def search(self, x: np.ndarray, width: int) -> list[int]:
        if self.entry < 0:
            return []
        at = [(float(self.distances(x, np.array([self.entry]))[0]), self.entry)]
        for level in range(len(self.near) - 1, 0, -1):
            at = self.walk(x, at[:1], 1, level)
        return [n for _, n in self.walk(x, at, width, 0)]

    def flat(self) -> list[dict[str, bytes]]:
        out = []
        for near in self.near:
            nodes = np.fromiter(near, np.int32, len(near))
            offsets = np.concatenate(([0], np.cumsum([len(v) for v in near.values()]))).astype(np.int32)
            neighbours = np.concatenate([np.zeros(0, np.int64), *near.values()]).astype(np.int32)
            out.append({"nodes": nodes.tobytes(), "offsets": offsets.tobytes(), "neighbours": neighbours.tobytes()})
        return out

    @classmethod
    def of(cls, data: np.ndarray, levels: list, entry: int) -> Graph:
        """A graph back from its flat arrays."""
        self = cls.__new__(cls)
        self.data = data
        self.entry, self.turn, self.seen = entry, 0, np.zeros(len(data), np.int64)
        self.near = []
        for level in levels:
            nodes, offsets, neighbours = (np.frombuffer(level[k], np.int32) for k in ("nodes", "offsets", "neighbours"))
            parts = np.split(neighbours.astype(np.int64), offsets[1:-1])
            self.near.append(dict(zip(nodes.tolist(), parts, strict=True)))
        return self


def distinct_vectors(rows: DataFrame, vec_id: str, vector: str, copies: int) -> DataFrame:
    """(vec, ids): every usable vector once with its ``copies`` smallest ids.

    The window's limit is applied before the shuffle, so a vector that a third of
    the rows share costs ``copies`` rows a task.
    """
    clean = rows.filter(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = clean.groupBy("vec", "id").agg(F.lit(1).alias("one")).withColumn("place", place).filter(F.col("place") <= copies)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def build(rows: DataFrame, vec_id: str, vector: str, copies: int, shard_rows: int = SHARD_ROWS,
          links: int = LINKS, build_width: int = BUILD_WIDTH) -> DataFrame:
    """The index: one row per shard, columns INDEX, in the shared checkpoint folder."""
    prepare_workers()
    nodes = materialised(distinct_vectors(rows, vec_id, vector, copies))
    shards = max(1, -(-nodes.count() // shard_rows))

    def shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", kind="stable")  # an order that no row order of Spark changes
        data = np.array(group["vec"].tolist(), np.float64)
        draw = (group["place"].to_numpy().astype(np.uint64) >> np.uint64(11)).astype(np.float64) / 2**53
        tops = np.floor(-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(np.int64)
        graph = Graph(np.ldexp(data, scale_of(data)), tops, links, build_width)
        return pd.DataFrame([{
            "shard": int(group["shard"].iloc[0]), "dim": data.shape[1], "vectors": data.tobytes(),
            "ids": [list(x) for x in group["ids"]], "levels": graph.flat(), "entry": graph.entry}])

    dealt = nodes.withColumn("dim", F.size("vec")).withColumn("place", F.xxhash64("vec")).withColumn(
        "shard", F.pmod("place", F.lit(shards)).cast("int"))
    # a shard is minutes of work on few bytes: partitions of its own, which are not put together by size
    dealt = dealt.repartition(SPREAD * shards, "dim", "shard")
    return materialised(dealt.groupBy("dim", "shard").applyInPandas(shard, INDEX))


def search(index: DataFrame, queries: DataFrame, k: int = 10, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every (query_id, vec).

    A query's own id is left out; ties go to the smaller id.
    """
    prepare_workers()
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    places = index.select(F.col("shard").alias("s"), F.col("dim").alias("d"))
    asked = queries.withColumn("dim", F.size("vec")).withColumn(
        "block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    # every query against every shard of its length, in blocks: the query set is stated, the shards few
    dealt = asked.join(places, F.col("dim") == F.col("d")).select(
        "query_id", "vec", "dim", F.col("s").alias("shard"), "block")
    tasks = SPREAD * blocks * max(1, places.count())
    stored = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def look(key: tuple, asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(stored) and len(asked):
            row = stored.iloc[0]
            data = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
            scale = scale_of(data)
            graph = Graph.of(np.ldexp(data, scale), row["levels"], int(row["entry"]))
            ids = row["ids"]
            for query, vec in zip(asked["query_id"], asked["vec"], strict=True):
                x, wide = np.asarray(vec, np.float64), width
                while True:
                    near = np.array(graph.search(np.ldexp(x, scale), wide), np.int64)
                    far = np.sqrt(((data[near] - x) ** 2).sum(axis=1))
                    least: dict[int, float] = {}  # an id with several vectors ranks by its nearest
                    for d, n in zip(far.tolist(), near.tolist(), strict=True):
                        for i in ids[n]:
                            if i != query and d < least.get(int(i), np.inf):
                                least[int(i)] = d
                    if len(least) >= k or wide >= len(data):
                        break
                    wide *= 2  # one id's many vectors fill the list: look further
                found += [(query, i, d) for d, i in sorted((d, i) for i, d in least.items())[:k]]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    key = ["dim", "shard", "block"]
    dealt, stored = dealt.repartition(tasks, *key), stored.repartition(tasks, *key)
    candidates = dealt.groupBy(*key).cogroup(stored.groupBy(*key)).applyInPandas(
        look, "query_id long, vec_id long, score double")
    nearest = candidates.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return nearest.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10,
            width: int = SEARCH_WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest rows of every row whose id is divisible by ``every``."""
    index = build(rows, vec_id, vector, copies=k + 1, shard_rows=shard_rows)
    asked = rows.filter((F.col(vec_id) % every == 0) & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vec")).distinct()
    return search(index, asked, k, width)
