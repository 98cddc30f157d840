"""Lists from what users played: factor-model re-ranking and catalogue expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.functions import predicates as is_
from viewloom.functions.payloads import item_payload, list_key
from viewloom.functions.scalars import name_or_blank
from viewloom.operators import counts, factors, fill
from viewloom.operators.ranking import id_lists
from viewloom.plans.reports import as_ids
from viewloom.sinks.lists import longer_than


def box_counts(
    plays: DataFrame,
    episodes: DataFrame,
    members: DataFrame | None = None,
    max_length: int | None = 11,
    product: str | None = is_.FREE_VOD_PRODUCT,
) -> DataFrame:
    """(user_id, item_id, plays) of one product, inside a catalogue subtree when one is given."""
    chosen = plays if product is None else plays.where(is_.product_is(F.col("product_key"), product))
    known = as_ids(chosen, "user_id", "content_id", max_length=max_length)
    counted = counts.play_counts(known, "user_id", "content_id")
    if members is not None:
        counted = counts.within(counted, members)
    return counts.series_or_self(counted, episodes, "user_id")


def box_counts_unfiltered(plays: DataFrame, episodes: DataFrame, product: str = is_.FREE_VOD_PRODUCT) -> DataFrame:
    """Earlier form: no id length rule and no subtree."""
    return box_counts(plays, episodes, None, None, product)


def list_counts(plays: DataFrame, episodes: DataFrame) -> DataFrame:
    """Counts for the file lists: every product."""
    return box_counts(plays, episodes, None, None, None)


def ott_counts(plays: DataFrame) -> DataFrame:
    """Counts of on-demand plays without roll-up."""
    chosen = plays.where(is_.play_is(F.col("play_type"), F.col("flag4"), is_.PLAY_VOD))
    return counts.play_counts(
        as_ids(chosen, "user_id", "content_id").withColumnRenamed("content_id", "item_id"), "user_id", "item_id"
    )


def cinema_counts(plays: DataFrame, product: str = is_.CINEMA_PRODUCT) -> DataFrame:
    chosen = plays.where(is_.product_is(F.col("product_key"), product))
    return counts.play_counts(
        as_ids(chosen, "user_id", "content_id").withColumnRenamed("content_id", "item_id"), "user_id", "item_id"
    )


def live_plays(plays: DataFrame) -> DataFrame:
    """(user_id, content_id) of live plays."""
    chosen = plays.where(is_.play_is(F.col("play_type"), F.col("flag4"), is_.PLAY_LIVE))
    return as_ids(chosen, "user_id", "content_id").select("user_id", "content_id")


def sample_counts(counted: DataFrame, n: int = 100) -> DataFrame:
    """The first n counts by user and item, for a look at the data."""
    return counted.orderBy("user_id", "item_id").limit(n)


def rerank_lists(
    counted: DataFrame, k: int, key_suffix: str, names: DataFrame | None = None, more_than: int = 0, **settings
) -> DataFrame:
    """(list_key, rank, user_id, item_id, score, payload): each user's items by predicted score.

    ``key_suffix`` follows the user in the key: ``5_10046284_0`` on set-top boxes, ``3_0`` on OTT.
    """
    ranked = factors.rerank_played(counted, k, **settings)
    gated = longer_than(ranked, more_than, "user_id") if more_than else ranked
    return user_lists(gated, key_suffix, names)


def user_lists(ranked: DataFrame, key_suffix: str, names: DataFrame | None = None) -> DataFrame:
    """Add key and payload to ranked user items."""
    named = ranked.withColumn("content_name", F.lit(None).cast("string"))
    if names is not None:
        lookup = names.select(F.col("content_id").alias("item_id"), "content_name")
        named = ranked.join(lookup, "item_id", "left")
    return named.withColumn("list_key", list_key(F.col("user_id"), key_suffix)).withColumn(
        "payload",
        item_payload(F.col("item_id"), F.col("rank"), name_or_blank(F.col("content_name"))),
    )


def rerank_text(counted: DataFrame, k: int = 15, **settings) -> DataFrame:
    """(user_id, items): the same lists as ``#``-joined ids."""
    return id_lists(factors.rerank_played(counted, k, **settings), ["user_id"], "item_id")


def cinema_lists(ranked: DataFrame, members: DataFrame, k: int = 20, seed: int = 42) -> DataFrame:
    """Each user's best film opens its catalogue; the pool of all catalogues fills up to k."""
    return fill.expand_best(ranked, members, fill.pool_of(members, "content_id"), k, seed)


def cinema_rerank(plays: DataFrame, members: DataFrame, k: int = 20, seed: int = 42, **settings) -> DataFrame:
    ranked = factors.rerank_played(cinema_counts(plays), k, seed=seed, **settings)
    lists = cinema_lists(ranked, members, k, seed)
    return lists.withColumn("list_key", list_key(F.col("user_id"), "5", is_.CINEMA_CATALOG, "0")).withColumn(
        "payload", item_payload(F.col("item_id"), F.col("rank"))
    )
