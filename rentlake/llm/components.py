"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlake.llm.scratch import Scratch


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _nearest(both).withColumn("m", F.least("u", "m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the smallest of them."""
    low = _nearest(edges)
    rest = edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Alternating large and small stars. A hub's links are never gathered: each star is a
    combined minimum and a join, whose hot keys adaptive execution splits. Each round is
    written, so a lost executor repeats one round at most.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = scratch.keep(edges, f"{name}_0")
    state, turn = None, 0
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state or not found[0]:
            break
        state, turn = found, turn + 1
        edges = scratch.keep(_small_star(_large_star(edges)), f"{name}_{turn}")
        scratch.clear(f"{name}_{turn - 1}")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
