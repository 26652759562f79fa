"""Reachability over edge tables: frontier loops with a visited anti-join and a depth bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodeweave.session import materialize


def reach(edges: DataFrame, sources: DataFrame, depth: int) -> DataFrame:
    """edges(src, dst), sources(src) -> (src, dst, hops): every node within `depth` steps at its least number of hops.

    A round joins the frontier with the edges and drops what was seen before, so cycles end;
    every round is written to the shared folder, which keeps plans short and survives lost executors.
    """
    e = edges.where("src is not null and dst is not null and src <> dst").select("src", "dst").distinct()
    seen = sources.where("src is not null").select("src", F.col("src").alias("dst"), F.lit(0).alias("hops")).distinct()
    seen = materialize(seen, "reach")
    frontier = seen
    for hop in range(1, depth + 1):
        step = frontier.select(F.col("src").alias("origin"), F.col("dst").alias("at")).join(e, F.col("at") == F.col("src")).select(F.col("origin").alias("src"), "dst").distinct()
        frontier = materialize(step.join(seen.select("src", "dst"), ["src", "dst"], "left_anti").withColumn("hops", F.lit(hop)), "reach")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen.where("hops > 0")


def best_paths(edges: DataFrame, sources: DataFrame, depth: int) -> DataFrame:
    """edges(src, dst, confidence) -> (src, dst, hops, confidence, path): one shortest path each, the weakest link as confidence.

    Among paths of the same length the most confident wins, then the smallest path.
    """
    e = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), "confidence")
    seen = sources.select("src", F.col("src").alias("dst"), F.lit(0).alias("hops"), F.lit(1.0).alias("confidence"), F.array("src").alias("path")).distinct()
    seen = materialize(seen, "paths")
    frontier = seen
    for hop in range(1, depth + 1):
        step = (
            frontier.withColumnRenamed("confidence", "c").join(e, F.col("dst") == F.col("a"))
            .select("src", F.col("b").alias("dst"), F.least("c", "confidence").alias("confidence"), F.concat("path", F.array("b")).alias("path"))
            .groupBy("src", "dst").agg(F.min(F.struct((-F.col("confidence")).alias("m"), "path")).alias("best"))
        )
        frontier = materialize(
            step.join(seen.select("src", "dst"), ["src", "dst"], "left_anti").select("src", "dst", F.lit(hop).alias("hops"), (-F.col("best.m")).alias("confidence"), F.col("best.path").alias("path")),
            "paths",
        )
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen.where("hops > 0")


def exhausted(edges: DataFrame, sources: DataFrame, depth: int) -> DataFrame:
    """(src, explored, complete): how many nodes lie within the depth, and whether there is none beyond it.

    Where it is complete, the lack of a path to any other node is proved; where it is not, it was only cut off.
    """
    beyond = reach(edges, sources, depth + 1)
    counts = beyond.groupBy("src").agg(F.count_if(F.col("hops") <= depth).alias("explored"), (F.count_if(F.col("hops") > depth) == 0).alias("complete"))
    return sources.select("src").distinct().join(counts, "src", "left").select("src", F.coalesce("explored", F.lit(0)).alias("explored"), F.coalesce("complete", F.lit(True)).alias("complete"))
