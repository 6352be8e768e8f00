"""Connected components of a graph held in a DataFrame.

Alternating star operations on an edge table: a large star ties every larger
neighbour of a node to the node's smallest neighbour, a small star does so for the
smaller ones. Both need the minimum per node (aggregated before the shuffle) and a
join, and end with a star around the smallest node of each component after a
number of rounds that grows with the logarithm of its size. A hub with a third of
all edges makes a skewed join that adaptive execution divides, never one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MOST_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node ``u`` to the smaller ``v``, before and after."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Tells whether two edge tables differ."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return int(row["n"]), int(row["s"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that is not the smallest of its component.

    ``edges``: two columns of one orderable type, in any direction; loops, repeated
    edges and nulls are dropped. Nodes without an edge have no row.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = written(edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(now)
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        now, before = written(_small_star(_large_star(now))), mark
        mark = _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"the components did not settle in {MOST_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
