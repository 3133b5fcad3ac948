"""Connected components over link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageprism.session import stored


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of each node's component: (node, component) for every node of ``edges`` (a, b: long; nulls and
    loops are ignored, but a loop's node counts).

    Alternates two steps until nothing changes: each node links its larger neighbours, then its smaller ones, to its smallest
    neighbour. Links are pre-aggregated as minima, so a node with many links is no hot group of rows; the number of rounds
    grows with the logarithm of the longest chain. Each round is written to the shared folder.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        links = stored(_towards_least(links.union(links.select("b", "a")), larger=True), "links")
        links = stored(_towards_least(links, larger=False), "links")
        state = links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == seen:
            break
        seen = state
    return nodes.join(links.select(F.col("a").alias("node"), F.col("b").alias("least")), "node", "left").select(
        "node", F.coalesce("least", "node").alias("component"))


def _towards_least(links: DataFrame, larger: bool) -> DataFrame:
    """Links (larger, smaller) to the least of each node's neighbours and itself. With ``larger`` from the node's larger neighbours,
    over links in both directions; else from its smaller ones and itself, over links (larger, smaller)."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = links.join(least, "a")
    if larger:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()
