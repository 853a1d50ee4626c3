"""Connected components over edge tables of any size, by alternating large-star and small-star steps.

No edge, node or component reaches the driver: each step is an aggregation and a join, and only one count and one checksum
come back. Edges of a hub would meet its minimum in one task; so the minima of nodes with more than `HUB` edges, or one in
HUBS of all edges, are broadcast, which are fewer than HUBS nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


HUB = 10_000
HUBS = 50_000


def _with_least(edges: DataFrame, at: str, total: int) -> DataFrame:
    """edges (a > b) with m: the least neighbour of their node `at` below it, else the node itself."""
    low = edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
    many = max(HUB, total // HUBS)
    plain = lambda e: e.join(low, e[at] == low["of"], "left").select("a", "b", F.coalesce("m", at).alias("m"))
    if total <= many:  # no node can be a hub
        return plain(edges)
    hubs = edges.groupBy(F.col(at).alias("hub")).agg(F.count("*").alias("c")).where(F.col("c") > many).select("hub")
    hubs = F.broadcast(hubs.join(low, F.col("hub") == F.col("of"), "left").select("hub", F.coalesce("m", "hub").alias("m")))
    others = plain(edges.join(hubs, F.col(at) == F.col("hub"), "left_anti"))
    return edges.join(hubs, F.col(at) == F.col("hub")).select("a", "b", "m").unionByName(others)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    return _with_least(edges, "b", total).select("a", F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    moved = _with_least(edges, "a", total).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(edges.groupBy("a").agg(F.min("b").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has an edge to another; root is the smallest node of its component.

    Edges may come in either direction and repeat; nulls and loops are ignored. No edges: no rows. The edges are written
    before the first step, which reads them more than once: their plan may give another forest of the same components
    each time it runs, and a step over two different forests could lose what holds a component together.
    """
    edges = checkpoint(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    told = lambda: tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    now, before = told(), None
    while now != before:
        edges = checkpoint(_small_star(checkpoint(_large_star(edges, now[0])), now[0]))
        now, before = told(), now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
