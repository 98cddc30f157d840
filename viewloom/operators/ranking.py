"""Ranked lists.

``row_number() <= k`` is planned with a group limit on both sides of the shuffle: every task
forwards at most k rows per group, so a group may hold any share of the rows. Spark does so for
k below 1,000; longer lists are first cut per salt of the group, with the same result. Windows
without such a limit are only put on lists that are already cut to k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Spark limits groups before the shuffle up to this k; beyond it groups are salted.
GROUP_LIMIT = 1000
SALTS = 64


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group, or of all rows without keys, with their position from 1."""
    if not keys:
        df = df.orderBy(*order).limit(k)
    elif k >= GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        w = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k).drop("_salt", rank)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def top_k_if_more(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, more_than: int, rank: str = "rank"
) -> DataFrame:
    """Top ``k`` of the groups that have more than ``more_than`` rows.

    Whether a group is large enough shows in its row number ``more_than + 1``, so no group is
    counted in full.
    """
    reach = max(k, more_than + 1)
    listed = top_k(df, keys, order, reach, rank)
    longest = F.max(rank).over(Window.partitionBy(*keys))
    return (
        listed.withColumn("_longest", longest)
        .where((F.col("_longest") > more_than) & (F.col(rank) <= k))
        .drop("_longest")
    )


def drop_repeated_names(ranked: DataFrame, keys: Sequence[str], name: str, rank: str = "rank") -> DataFrame:
    """Keep the best ranked row of each name; ranks keep their gaps."""
    w = Window.partitionBy(*keys, name).orderBy(rank)
    return ranked.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def renumber(ranked: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Close the gaps of short lists."""
    return ranked.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def with_optional_grain(df: DataFrame, column: str) -> DataFrame:
    """Every row twice: once with ``column`` kept and once with it NULL (the coarser list)."""
    kept = F.col(column).cast("string")
    both = F.array(F.lit(None).cast("string"), kept)
    return df.withColumn(column, F.explode(both))


def at_least(df: DataFrame, more_than: int) -> DataFrame:
    """All rows when there are more than ``more_than`` of them, none otherwise.

    The check is a subquery of one row that reads no more rows than it has to see; nothing runs before
    the query itself does.
    """
    enough = df.limit(more_than + 1).agg(F.count(F.lit(1)) > more_than)
    return df.where(enough.scalar())


def id_lists(ranked: DataFrame, keys: Sequence[str], item: str, rank: str = "rank") -> DataFrame:
    """One row per key with its ids in rank order, joined by ``#``."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(item).cast("string").alias("id"))))
    return (
        ranked.groupBy(*keys)
        .agg(pairs.alias("_pairs"))
        .select(*keys, F.concat_ws("#", F.transform("_pairs", lambda p: p["id"])).alias("items"))
    )
