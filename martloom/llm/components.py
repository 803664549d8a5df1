"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import stored


def _least(edges: DataFrame) -> DataFrame:
    """``node``, ``least``: the smallest of a node's neighbours and itself."""
    return edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return (
        both.filter(F.col("other") > F.col("node"))
        .join(_least(both), "node")
        .select(F.col("other").alias("node"), F.col("least").alias("other"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Every edge leads downwards."""
    least = _least(edges)
    moved = edges.join(least, "node").select(F.col("other").alias("node"), F.col("least").alias("other"))
    return moved.union(least).filter(F.col("node") > F.col("other")).distinct()


def _state(edges: DataFrame) -> tuple:
    sign = F.xxhash64("node", "other")
    return tuple(edges.agg(F.count("*"), F.bit_xor(sign), F.sum(F.shiftright(sign, 20))).first())


def components(edges: DataFrame) -> DataFrame:
    """The least node reachable from every node that has an edge.

    ``edges`` has two long columns ``a`` and ``b``; direction, repeats and loops
    do not matter, rows with a NULL are left out. Returns ``node``, ``root``, one
    row per node with an edge to another node. Each round is written to the
    shared folder; a round shuffles the edges, never a whole component into one
    task, and the number of rounds grows with the logarithm of the longest path.
    """
    known = edges.select("a", "b").dropna()
    downwards = known.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    now = stored(downwards.filter(F.col("node") > F.col("other")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct()
    return now.select("node", F.col("other").alias("root")).union(roots)
