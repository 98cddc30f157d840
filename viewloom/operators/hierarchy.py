"""Catalogue trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.session import cut_lineage
from viewloom.sources.metadata import catalog_members


def descendants(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(content_id) of everything below the ``starts`` catalogues; the starts only when an edge leads to them.

    ``edges`` has catalog_id, content_id. One join per tree level; ids already reached are left
    out, so cycles end. Every level is checkpointed, which keeps the plan short and the work
    safe against lost executors.
    """
    edges = cut_lineage(edges.select("catalog_id", "content_id").distinct())

    def children(parents: DataFrame) -> DataFrame:
        return edges.join(parents, "catalog_id", "left_semi").select("content_id").distinct()

    frontier = cut_lineage(children(starts.select("catalog_id")))
    reached = frontier
    while not frontier.isEmpty():
        parents = frontier.withColumnRenamed("content_id", "catalog_id")
        frontier = cut_lineage(children(parents).join(reached, "content_id", "left_anti"))
        reached = reached.unionByName(frontier)
    return reached


def subtree(catalog: DataFrame, root: int) -> DataFrame:
    """All ids in the children lists of the root's sub-catalogues, followed to the leaves."""
    starts = catalog.where(F.col("parent_id") == root)
    return descendants(catalog_members(catalog), starts)
