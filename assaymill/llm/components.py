"""Connected components by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over directed (u, v): every u ties its neighbours to the least of them and itself.

    The least neighbour is pre-aggregated per u before it moves; the edges of a hot u meet it in
    an equi-join, whose large partitions Spark splits.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = around.join(least, "u")
    if large:
        return tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    ends = tied.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return ends.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); the component is its least node.

    Ends when a round changes no edge; the number of rounds is logarithmic in the longest path.
    """
    edges = staged(links.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    known = None
    while True:
        grown = _star(edges, large=True)
        edges = staged(_star(grown, large=False).where(F.col("u") != F.col("v")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == known:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        known = now
