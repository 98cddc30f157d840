"""An index of a catalogue tree that answers membership by position.

Every node gets its place in the order of a walk through the tree and the place of the last node below it, so a subtree is
an interval, and membership is one range test on a table that is sorted by place. Paths to the root grow by pointer doubling, in as many
rounds as the depth has binary digits.

A node of several parents stands below the smallest of them, and a cycle is cut above its smallest node. The edges that
are left out so are kept as links: a subtree that holds the upper end of a link also holds the lower end and what is below it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.operators.positions import AT, numbered
from viewloom.operators.spans import join_points
from viewloom.session import cut_lineage


@dataclass(frozen=True)
class TreeIndex:
    """``nodes``: id, place, last, depth, sorted by place; ``links``: from_place, first, last of the edges left out."""

    nodes: DataFrame
    links: DataFrame
    levels: int


def _without_cycles(parents: DataFrame) -> DataFrame:
    """(id, parent) with the parent of each cycle's smallest node taken off; a node is its own parent at the top."""
    # A pointer and the least node on the way to it, the start left out.
    walk = cut_lineage(parents.select("id", F.col("parent").alias("far"), F.col("parent").alias("least")))
    left, steps = 1, 1
    # Walks that have taken more steps than there are walks left go round in circles, and have seen all of them.
    while steps <= left:
        ahead = walk.select(F.col("id").alias("far"), F.col("far").alias("next"), F.col("least").alias("more"))
        joined = walk.join(ahead, "far", "left")
        walk = cut_lineage(joined.select("id", F.col("next").alias("far"), F.least("least", "more").alias("least")).where("far IS NOT NULL"))
        left, steps = walk.count(), 2 * steps
        if not left:
            return parents
    # The least node of a cycle meets itself.
    tops = walk.where("least = id").select("id")
    return cut_lineage(parents.join(tops, "id", "left_anti"))


def tree_index(edges: DataFrame) -> TreeIndex:
    """The index of ``edges`` (catalog_id, content_id), numbers that aren't null; repeated edges and loops of one node don't matter."""
    pairs = cut_lineage(
        edges.where("catalog_id IS NOT NULL AND content_id IS NOT NULL AND catalog_id <> content_id").select("catalog_id", "content_id").distinct()
    )
    chosen = _without_cycles(cut_lineage(pairs.groupBy(F.col("content_id").alias("id")).agg(F.min("catalog_id").alias("parent"))))
    ids = pairs.select(F.col("catalog_id").alias("id")).union(pairs.select(F.col("content_id").alias("id"))).distinct()
    # way: the ids from just below ``far`` to the node.
    paths = cut_lineage(ids.join(chosen, "id", "left").select("id", F.col("parent").alias("far"), F.array("id").alias("way")))
    while not paths.where("far IS NOT NULL").isEmpty():
        above = paths.select(F.col("id").alias("far"), F.col("far").alias("next"), F.col("way").alias("before"))
        joined = paths.join(above, "far", "left")
        way = F.concat(F.coalesce("before", F.array().cast("array<bigint>")), "way")
        paths = cut_lineage(joined.select("id", F.col("next").alias("far"), way.alias("way")))
    placed = numbered(paths.select("id", "way"), ["way"])
    sizes = placed.select(F.explode("way").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("below"))
    rows = placed.join(sizes, "id").select(
        "id", F.col(AT).alias("place"), (F.col(AT) + F.col("below") - 1).alias("last"), F.size("way").alias("depth")
    )
    nodes = cut_lineage(rows.repartitionByRange("place").sortWithinPartitions("place"))
    other = pairs.join(chosen.select(F.col("id").alias("content_id"), F.col("parent").alias("catalog_id")), ["catalog_id", "content_id"], "left_anti")
    upper = nodes.select(F.col("id").alias("catalog_id"), F.col("place").alias("from_place"))
    lower = nodes.select(F.col("id").alias("content_id"), F.col("place").alias("first"), "last")
    links = cut_lineage(other.join(upper, "catalog_id").join(lower, "content_id").select("from_place", "first", "last"))
    return TreeIndex(nodes, links, max(1, nodes.count().bit_length()))


def members_below(index: TreeIndex, starts: DataFrame) -> DataFrame:
    """(content_id) of everything below the ``starts`` (catalog_id); a start itself only when an edge leads to it."""
    asked = index.nodes.join(starts.select(F.col("catalog_id").alias("id")).distinct(), "id", "left_semi")
    # A link may begin at a start itself, which isn't a member.
    reach = cut_lineage(asked.select(F.col("place").alias("first"), "last"))
    members = cut_lineage(asked.where("last > place").select((F.col("place") + 1).alias("first"), "last"))
    links, taken = index.links, index.links.limit(0)
    while True:
        points = links.join(taken, links.columns, "left_anti") if taken is not None else links
        met = join_points(reach.select("first", (F.col("last") + 1).alias("end")), points.withColumnRenamed("first", "low").withColumnRenamed("last", "high"), "first", "end", "from_place", index.levels)
        new = cut_lineage(met.select("from_place", F.col("low").alias("first"), F.col("high").alias("last")).distinct())
        if new.isEmpty():
            break
        taken = cut_lineage(taken.union(new))
        reach = new.select("first", "last")
        members = members.union(reach)
    spans = members.select("first", (F.col("last") + 1).alias("end"))
    found = join_points(spans, index.nodes, "first", "end", "place", index.levels)
    return found.select(F.col("id").alias("content_id")).distinct()


def inside(rows: DataFrame, index: TreeIndex, root: int, on: str = "place") -> DataFrame:
    """``rows`` with a ``place`` in the subtree of ``root`` by tree edges, the root included: one range, which reaches the scan."""
    node = index.nodes.where(F.col("id") == root).first()
    if node is None:
        return rows.limit(0)
    return rows.where(F.col(on).between(node["place"], node["last"]))
