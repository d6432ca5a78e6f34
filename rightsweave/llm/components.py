"""Connected components by alternating large-star and small-star rounds.

Each round replaces the edges by edges to the smallest known neighbour, first
from the larger neighbours of every node, then from the smaller ones; the
rounds end when the edge set no longer changes, which leaves one star per
component.  Every round is written to the shared folder (bounded lineage), and
only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first())


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with the smallest v of its u as m."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the long pairs (src, dst); root is the smallest node reachable.

    Pairs with a null end and loops carry no link and are left out; a node
    without any other link has no row.  Repeated pairs count once.
    """
    now = materialize(edges.where("src != dst").select(F.greatest("src", "dst").alias("u"),
                                                       F.least("src", "dst").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_to_smallest(both).withColumn("m", F.least("u", "m")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # the smallest neighbour itself is linked to u; its own row (v = m) turns into that edge
        small = _to_smallest(large).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                           F.col("m").alias("v")).distinct()
        now = materialize(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
