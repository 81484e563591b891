"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import discard, stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); component: its smallest reachable node.

    Each round replaces the links of a node by links to the smallest node around it: first for larger neighbours, then
    for smaller ones.  Rounds grow with the logarithm of the longest path.  Every round is one written table, so lineage
    stays short; nothing but two sums per round reaches the driver.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        fresh = stored(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), "links")
        discard(edges)
        edges = fresh
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
