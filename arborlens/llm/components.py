"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step is an aggregation and a join, and nothing but counts reaches the driver; the rounds
grow with the logarithm of the nodes. The few nodes that hold a hundredth of the edge ends each
are joined by a small broadcast, so the edges of a hub stay where they are. Edges are written to
the shared checkpoint folder after each round. As soon as no more than ``in_a_task`` edges are left,
one task finds what they still join; a graph that starts so small needs no rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlens.llm.common import cut, cut_small

#: Edges that one task may hold: some 50 MB of Python's memory.
EDGES_IN_A_TASK = 200_000
#: A node with more than this share of all edge ends is a hub, so there are at most 100.
HUB = 0.01


def _with_least(edges: DataFrame, least: DataFrame, ends: int) -> DataFrame:
    """edges (u, v) with m of least (u, c, m): hubs by a broadcast of at most 1 / HUB rows, the others by a join."""
    hubs = F.broadcast(least.where(F.col("c") > max(1000, HUB * ends)).select("u", F.col("m").alias("h")))
    known = edges.join(hubs, "u", "left")
    return known.where("h is null").drop("h").join(least.select("u", "m"), "u").unionByName(known.where("h is not null").withColumnRenamed("h", "m"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Of edges (u, v), v < u: each node hands the least of its neighbours and itself to its larger neighbours. May repeat edges."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = edges.unionByName(back).groupBy("u").agg(F.count(F.lit(1)).alias("c"), F.least(F.min("v"), F.col("u")).alias("m"))
    # an edge down to u is one of its larger neighbours
    return _with_least(back, least, 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Each node hands the least of its smaller neighbours to the others and itself."""
    least = edges.groupBy("u").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("m"))
    moved = _with_least(edges, least, n).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down, or only edges up."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("x").agg(F.sum("down").alias("d"), F.max("up").alias("p")).where("d > 1 or (d = 1 and p = 1)").isEmpty()


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each node to the least of its component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(u), root(v)
            parent[max(x, y)] = min(x, y)
    stars = [(u, r) for u in list(parent) if (r := root(u)) != u]
    for i in range(0, len(stars), 100_000):
        u, v = zip(*stars[i : i + 100_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, in_a_task: int = EDGES_IN_A_TASK) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node. Self-loops and null ends are left out."""
    pairs = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    pairs = cut_small(pairs)
    for _ in range(most_rounds):
        n = pairs.count()
        if n <= in_a_task:
            pairs = cut(pairs.coalesce(1).mapInArrow(_stars, "u long, v long"))
            break
        if _are_stars(pairs):
            break
        pairs = cut_small(_small_star(cut_small(_large_star(pairs, n)), n))
    else:
        raise RuntimeError(f"components not found in {most_rounds} rounds")
    # every edge now leads from a node to the least node of its component
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
