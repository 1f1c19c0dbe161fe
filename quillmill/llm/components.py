"""Connected components of a distributed edge list by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).  Each step is one
pre-aggregated minimum per node and one join on the node; no neighbour list is ever gathered, and
nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import discard, materialize


def _minimum(edges: DataFrame) -> DataFrame:
    """Smallest of each node's neighbours and itself; ``edges`` holds (u, v).

    It is written out: a join of two plain exchanges has the partitions of a node with very many
    neighbours split, a join with an aggregate has not.
    """
    return materialize(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minimum(both)
    out = materialize(both.where("v > u").join(least.hint("shuffle_merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-star")
    discard(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _minimum(down)
    moved = down.join(least.hint("shuffle_merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    out = materialize(moved.union(least.select("u", F.col("m").alias("v")).where("u <> v")).distinct(), "small-star")
    discard(least)
    return out


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node that has an edge; component is the smallest node reached.

    ``edges`` has two long columns.  Self-loops, repeated edges and either direction are fine; a
    node without an edge to another one is absent from the result.  Null ends are ignored.
    """
    a, b = edges.columns[:2]
    current = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    current = materialize(current, "edges")
    mark = None
    for _ in range(max_rounds):
        larger = _large_star(current)
        discard(current)
        current = _small_star(larger)
        discard(larger)
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    out = materialize(current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    discard(current)
    return out
