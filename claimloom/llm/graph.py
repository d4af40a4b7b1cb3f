"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, map_blocks, stored

#: Edges that a worker joins at once, before any are shuffled.
CHUNK = 100_000


def _star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are joined to the least node around it, then its smaller ones likewise."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.unionByName(least.where("u > m").select("u", F.col("m").alias("v"))).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _locally(block: pa.Table) -> pa.Table:
    """A chunk's own components as stars: fewer edges, and fewer rounds, with the same components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in zip(block["u"].to_pylist(), block["v"].to_pylist()):
        low, high = sorted((root(u), root(v)))
        parent[high] = low
    star = [(x, root(x)) for x in parent if root(x) != x]
    return pa.table({"u": pa.array([x for x, _ in star], pa.int64()), "v": pa.array([r for _, r in star], pa.int64())})


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node with an edge; the label is the least node it reaches.

    Rounds grow with the logarithm of a component's diameter. Each round's edges are a
    table in the shared folder, so that a lost executor costs no earlier round.
    """
    sides = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    now = stored(map_blocks(sides, _locally, "u bigint, v bigint", column="u", limit=CHUNK * 8), "edges")
    seen = _print(now)
    while seen[0]:
        then = stored(_star(now), "edges")
        drop_stored(now)
        now, before, seen = then, seen, _print(then)
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
