"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.session import written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (u, v; longs) reaches.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows. Each step is an aggregation and a join, and its
    result is written; the number of rounds grows with the logarithm of the longest path.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(both: DataFrame, larger: bool) -> DataFrame:
        """``both`` holds pairs (u, v); hand v to the smallest of u and its v's."""
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
        handed = both.where("v > u") if larger else both
        moved = handed.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        if not larger:
            moved = moved.unionByName(least.select("u", F.col("least").alias("v")))
        return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    pairs = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(pairs, "component-edges")
    before = state(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = written(star(both, True), "component-edges")
        edges = written(star(edges, False), "component-edges")
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
