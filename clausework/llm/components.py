"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stored

# rounds after which something must be wrong; each round about halves the depth of every tree
MAX_ROUNDS = 60


def _min_of(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy(F.col(node).alias("at")).agg(F.min(other).alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest in its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _min_of(both, "u", "v").select("at", F.least("at", "low").alias("low"))
    return (both.join(low, F.col("u") == F.col("at")).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = _min_of(edges, "u", "v")
    joined = edges.join(low, F.col("u") == F.col("at"))
    moved = joined.where(F.col("v") > F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select(F.col("at").alias("u"), F.col("low").alias("v")))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is a ``u``."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    counts = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.sum("e.down").alias("down"))
    return counts.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for every node of an edge: the smallest node that it reaches.

    Every round relinks larger neighbours to the smallest neighbour (large
    star), then smaller ones (small star), until only stars are left; the
    number of rounds grows with the logarithm of the longest path. A hub's
    minimum is pre-aggregated and its links are joined, never grouped, so that
    a node with many links is split over tasks. Each round is written to the
    shared folder. Links of a node to itself and repeated links change nothing;
    a node without links to others is not listed.
    """
    e = (edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
         .where(F.col("u") > F.col("v")).distinct())
    e = stored(e, "links")
    for _ in range(MAX_ROUNDS):
        if _is_forest_of_stars(e):
            roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        e = stored(_small_star(_large_star(e).distinct()).distinct(), "links")
    raise RuntimeError("the components did not settle")
