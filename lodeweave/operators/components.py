"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the node, so a hub with very many
neighbours is pre-aggregated and AQE may split its join. A round ends with a test
whether the edges are stars already (no node is both a root and a member, none has
two roots); that one bit is all that comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodeweave.session import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.join(low, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("m").alias("a"), F.col("v").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # edges are kept as a < b: the smaller neighbours of b are its a's
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    kept = low.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return (
        moved.unionByName(kept)
        .where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is a root or has exactly one: then another round would change nothing."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(0).alias("parents")), F.struct(F.col("b").alias("v"), F.lit(1).alias("parents")))).alias("x"))
    odd = ends.groupBy("x.v").agg(F.sum("x.parents").alias("parents"), F.min("x.parents").alias("least")).where("parents > 1 or parents = 1 and least = 0")
    return odd.isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """edges(a bigint, b bigint) -> (root, node) for every node that is not its component's smallest.

    Null ends, loops and repeated edges are dropped; no edges give no rows.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
    e = materialize(e, "cc")
    for _ in range(max_rounds):
        if _are_stars(e):
            return e.select(F.col("a").alias("root"), F.col("b").alias("node"))
        before, e = e, materialize(_small_star(_large_star(e)), "cc")
        discard(before)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
