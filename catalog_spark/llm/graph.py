"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; ``edges`` has rows (u, v) with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge other than the root, the root being the smallest node reachable.

    Edges in any direction, repeated or from a node to itself are fine; rows with a null end are ignored.
    Alternating stars: minima combine map-side, no neighbour list is gathered, and each step is written
    to the shared folder, so the lineage stays short and a lost executor costs one step at most.
    """
    step = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(),
        "edges",
    )
    state = None
    while True:
        row = step.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == state or row[0] == 0:
            return step.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = row
        step = materialize(_stars(step), "edges")
