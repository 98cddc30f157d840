"""Connected components by the smallest label, in rounds that are written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.session import cut_lineage


def components(links: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """(node, label) for every node of ``links``: label is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the label of that label,
    so that chains shorten by half a round. Only counts reach the driver.
    """
    both = links.select(F.col(left).alias("node"), F.col(right).alias("other")).union(
        links.select(F.col(right).alias("node"), F.col(left).alias("other"))
    )
    edges = cut_lineage(both.where(F.col("node") != F.col("other")).distinct())
    labels = cut_lineage(edges.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("label")))
    while True:
        told = edges.join(labels.select(F.col("node").alias("other"), F.col("label").alias("heard")), "other")
        least = told.groupBy("node").agg(F.min("heard").alias("heard"))
        near = labels.join(least, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        done = near.join(jump, "label", "left").select("node", "old", F.least("label", "far").alias("label"))
        done = cut_lineage(done)
        changed = done.where(F.col("old") != F.col("label")).limit(1).count()
        labels = done.select("node", "label")
        if not changed:
            return labels
