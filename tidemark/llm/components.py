"""Connected components by repeated contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.staging import broadcast_if_small, shuffled, stored


def components(links: DataFrame) -> DataFrame:
    """id LONG, component LONG (the smallest id reachable) for every id in ``links`` (a LONG, b LONG).

    Each node points to its neighbour, or itself, of the lowest random priority; the graph is then
    drawn between the nodes pointed to. That leaves a fraction of the nodes of a path and collapses
    a star of any size, so rounds grow with the logarithm of the number of nodes. Every round is
    written to the shared folder. Loops and repeated links do no harm; no links give no rows.
    """
    def node(c: str):
        return F.struct(F.xxhash64(F.lit(17), c).alias("rank"), F.col(c).alias("id"))

    edges = stored(links.where("a != b").select(node("a").alias("a"), node("b").alias("b")), "links")
    labels = edges.select(F.explode(F.array("a", "b")).alias("at")).distinct().select(
        F.col("at.id").alias("id"), "at")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        lowest = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("other"))
        lowest = stored(lowest.select("at", F.least("at", "other").alias("to")), "lowest")
        lowest = broadcast_if_small(lowest)
        labels = stored(shuffled(labels).join(lowest, "at", "left").select("id", F.coalesce("to", "at").alias("at")), "labels")
        for c in ("a", "b"):
            edges = shuffled(edges).join(lowest.withColumnRenamed("at", c), c).drop(c).withColumnRenamed("to", c)
        # The lower node first, so that a link met from both sides is one row.
        edges = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = stored(edges.distinct(), "links")
    smallest = labels.groupBy("at").agg(F.min("id").alias("component"))
    return shuffled(labels).join(smallest, "at").select("id", "component")
