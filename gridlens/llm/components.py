"""Connected components of an edge table, by alternating star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import staged


def _relink(edges: DataFrame, towards_larger: bool) -> DataFrame:
    """One star step.

    Every node takes the smallest id around it.  The large step hangs the node's
    larger neighbours below that id, the small step its smaller ones and itself.
    The minimum is a partially aggregated group and meets the edges in a plain
    join, so a hub's neighbours are never gathered in one place.
    """
    if towards_larger:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b")
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        near = down.join(low, "a").select(F.col("m").alias("a"), "b")
        out = near.union(low.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return out.where("a <> b").distinct()


def _is_settled(edges: DataFrame) -> bool:
    """True when the edges are stars: no centre hangs below another node, and no node below two."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("centre"), F.lit(0).alias("below")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("id").agg(F.max("centre").alias("centre"), F.sum("below").alias("below"))
    return seen.where("centre + below > 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, label) for every id that has an edge; the label is the component's smallest id.

    ``edges`` holds long columns a and b in any order; self loops and repeats are
    harmless.  The number of rounds grows with the logarithm of the longest chain.
    """
    current = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                                  F.greatest("a", "b").alias("b")).distinct(), "edges")
    while not _is_settled(current):
        current = staged(_relink(_relink(current, True), False), "edges")
    return current.select(F.col("b").alias("id"), F.col("a").alias("label")).union(
        current.select(F.col("a").alias("id"), F.col("a").alias("label")).distinct())
