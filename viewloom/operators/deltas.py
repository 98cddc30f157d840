"""Pair moments that follow changed ratings.

Moments are sums over raters, so they change by what the changed ratings add and take away. A changed rating is joined with its
user's ratings only: every pair of which one side changed gives its new products, less its old ones where both
ratings were there before. Users without a change are not read by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.operators.cooccurrence import unique_ratings

SUMS = ["n", "xy", "x", "y", "xx", "yy"]


def rating_changes(stored: DataFrame, new: DataFrame) -> DataFrame:
    """(user_id, item_id, rating, old): new and raised ratings, the largest of a user and item counting; ``old`` is null for new ones.

    ``stored`` has one row per user and item.
    """
    largest = unique_ratings(new)
    old = stored.select("user_id", "item_id", F.col("rating").alias("old"))
    joined = largest.join(old, ["user_id", "item_id"], "left")
    return joined.where("old IS NULL OR rating > old")


def merged_ratings(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """The ratings after the changes."""
    kept = stored.join(changes.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return kept.select("user_id", "item_id", "rating").unionByName(changes.select("user_id", "item_id", "rating"))


def moment_changes(stored: DataFrame, changes: DataFrame, slice_items: int = 1000) -> DataFrame:
    """(item1, item2, n, xy, x, y, xx, yy): what the changes add to the moments of every pair they touch.

    The ratings of a user with more than ``slice_items`` of them are dealt into slices, each of which meets all of the
    user's changes, so no task gets all pairs of a heavy user.
    """
    touched = changes.select("user_id").distinct()
    rows = (
        stored.join(touched, "user_id", "left_semi")
        .select("user_id", "item_id", F.col("rating").alias("old"))
        .join(changes.select("user_id", "item_id", "rating"), ["user_id", "item_id"], "full")
    )
    rows = rows.select("user_id", "item_id", "old", F.coalesce("rating", "old").alias("rating"), F.col("rating").isNotNull().alias("changed"))
    heavy = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > slice_items)
    heavy = heavy.select("user_id", F.ceil(F.col("_n") / slice_items).cast("int").alias("_slices"))
    sliced = rows.join(heavy, "user_id", "left").withColumn("_slices", F.coalesce("_slices", F.lit(1)))
    left = sliced.where("changed").select(
        "user_id",
        F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("slice"),
        F.col("item_id").alias("i"),
        F.col("rating").alias("ri"),
        F.col("old").alias("oi"),
    )
    right = sliced.select(
        "user_id",
        F.pmod(F.xxhash64("item_id"), F.col("_slices")).cast("int").alias("slice"),
        F.col("item_id").alias("j"),
        F.col("rating").alias("rj"),
        F.col("old").alias("oj"),
        F.col("changed").alias("cj"),
    )
    # A pair of two changed ratings is met from both sides and taken from one.
    pairs = left.join(right, ["user_id", "slice"]).where("i <> j AND (NOT cj OR i < j)")
    first = F.col("i") < F.col("j")

    def ordered(a: str, b: str, name: str):
        return F.when(first, F.struct(F.col(a).alias("x"), F.col(b).alias("y"))).otherwise(F.struct(F.col(b).alias("x"), F.col(a).alias("y"))).alias(name)

    each = pairs.select(F.least("i", "j").alias("item1"), F.greatest("i", "j").alias("item2"), ordered("ri", "rj", "new"), ordered("oi", "oj", "old"))
    both = F.col("old.x").isNotNull() & F.col("old.y").isNotNull()

    def change(value):
        return F.sum(value("new") - F.when(both, value("old")).otherwise(0.0))

    return each.groupBy("item1", "item2").agg(
        F.sum(F.when(both, 0.0).otherwise(1.0)).alias("n"),
        change(lambda s: F.col(f"{s}.x") * F.col(f"{s}.y")).alias("xy"),
        change(lambda s: F.col(f"{s}.x")).alias("x"),
        change(lambda s: F.col(f"{s}.y")).alias("y"),
        change(lambda s: F.col(f"{s}.x") * F.col(f"{s}.x")).alias("xx"),
        change(lambda s: F.col(f"{s}.y") * F.col(f"{s}.y")).alias("yy"),
    )


def merged_moments(moments: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored moments and their changes, added up by pair."""
    both = moments.select("item1", "item2", *SUMS).unionByName(changes.select("item1", "item2", *SUMS))
    return both.groupBy("item1", "item2").agg(*[F.sum(c).alias(c) for c in SUMS])


def with_raters(moments: DataFrame, ratings: DataFrame) -> DataFrame:
    """Moments with n1 and n2, the raters of both items."""
    raters = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("raters"))
    first = raters.select(F.col("item_id").alias("item1"), F.col("raters").alias("n1"))
    second = raters.select(F.col("item_id").alias("item2"), F.col("raters").alias("n2"))
    return moments.join(first, "item1").join(second, "item2")
