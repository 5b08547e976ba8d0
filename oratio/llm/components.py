"""Connected components over an edge table, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins; the edges of a round are written to the checkpoint
folder and read back, so lineage stays short and a lost executor repeats one round at most. The
number of rounds grows with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over (u, v) edges, u > v. Large: every node's greater neighbours move to its
    least neighbour; small: its smaller neighbours and itself do. The least neighbour comes from a
    partial aggregation, so a hub is joined back as one row and AQE may split its edges."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def settled(edges: DataFrame) -> bool:
    """Whether the edges (u, v), all different, are stars: every node below has one centre, and no centre lies below another.
    Then the centres name the components, and no further round is needed to see that nothing moves."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("centre")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("centre")))
    return ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("centre").alias("centre")).where(
        "below > 1 OR (below = 1 AND centre = 1)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, component) for every node of the edge table ``(u, v)`` (any two long columns named so);
    ``component`` is the least node reachable. Null ends, loops and repeated edges are ignored."""
    e = (edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    for _ in range(max_rounds):
        e = cut_lineage(_star(_star(e, True), False))
        if settled(e):
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
