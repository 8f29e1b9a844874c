"""Connected components of links, by alternating large and small stars over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaiq.llm.common import cut, discard


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: each node's neighbours are tied to its least one. Large: those above the node; small: those below, and itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and label, the least node that can be reached, for every node of the links (u, v): longs.

    A node's neighbours never come together in one place: each step takes minima and joins them back. Links that are
    repeated, or of a node with itself, add nothing; without links there are no rows.
    """
    edges = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
        last, edges = edges, cut(_star(_star(edges, large=True), large=False))
        discard(last)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
