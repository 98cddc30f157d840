"""Most-viewed lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions import predicates as is_
from viewloom.functions.payloads import item_payload, list_key, top_list_payload
from viewloom.functions.scalars import default_if_blank
from viewloom.operators import counts
from viewloom.operators.ranking import drop_repeated_names, id_lists, top_k, top_k_if_more, with_optional_grain
from viewloom.plans.reports import as_ids
from viewloom.sinks.lists import longer_than, one_list_per_key
from viewloom.sources.metadata import level_rows, one_row_per_key


def _by_views(*ids: str, truncate: bool = False) -> list[Column]:
    views = F.floor("views") if truncate else F.col("views")
    return [views.desc(), *[F.asc(i) for i in ids]]


def _counted(plays: DataFrame, product: str | None = None, min_seconds: int | None = None) -> DataFrame:
    """Plays per content."""
    chosen = plays if product is None else plays.where(is_.product_is(F.col("product_key"), product))
    if min_seconds is not None:
        chosen = chosen.where(is_.watched_longer_than(F.col("watch_seconds"), min_seconds))
    return counts.play_counts(as_ids(chosen, "content_id"), "content_id")


def box_top(
    plays: DataFrame, episodes: DataFrame, films: DataFrame, k: int = 20, product: str | None = is_.FREE_VOD_PRODUCT
) -> DataFrame:
    """Films and series of the free catalogue by views, each list only with more than k candidates.

    Repeated names lose the lower rank, and the gap stays.
    """
    return box_top_of(_counted(known_users(plays, product)), episodes, films, k)


def known_users(plays: DataFrame, product: str | None = is_.FREE_VOD_PRODUCT) -> DataFrame:
    """Plays of one product by users with an id."""
    known = plays.where(is_.valid_ids(F.col("user_id")))
    return known if product is None else known.where(is_.product_is(F.col("product_key"), product))


def box_top_of(counted: DataFrame, episodes: DataFrame, films: DataFrame, k: int = 20) -> DataFrame:
    """``box_top`` of plays that are counted already: (content_id, plays), for instance over a rolling window."""
    views = counts.views_by_item(counted, episodes, films=films)
    ranked = top_k_if_more(views, ["series_type"], _by_views("item_id"), k, k)
    lists = drop_repeated_names(ranked, ["series_type"], "item_name")
    root = is_.FREE_VOD_ROOT
    suffix = F.when(F.col("series_type") == 1, F.lit("1"))
    return lists.withColumn("list_key", list_key("Topcontentlist", "5", root, suffix)).withColumn(
        "payload",
        top_list_payload(F.col("item_id"), F.col("rank"), F.col("item_name"), parent_id=F.lit(root)),
    )


def cinema_top(plays: DataFrame, films: DataFrame, k: int = 20, product: str | None = is_.CINEMA_PRODUCT) -> DataFrame:
    """Cinema films by plays."""
    users_known = plays.where(is_.valid_ids(F.col("user_id")))
    counted = _counted(users_known, product).join(films, "content_id")
    views = counted.withColumnsRenamed({"content_id": "item_id", "content_name": "item_name", "plays": "views"})
    ranked = top_k_if_more(views, [], _by_views("item_id"), k, k)
    return (
        drop_repeated_names(ranked, [], "item_name")
        .withColumn("list_key", list_key("Topcontentlist", "5", is_.CINEMA_CATALOG))
        .withColumn(
            "payload", top_list_payload(F.col("item_id"), F.col("rank"), F.col("item_name"), parent_id=F.lit(is_.CINEMA_PARENT))
        )
    )


def level_top(
    plays: DataFrame,
    episodes: DataFrame,
    levels: DataFrame,
    k: int = 20,
    min_seconds: int = 60,
    more_than: int = 5,
    truncate: bool = False,
) -> DataFrame:
    """Top lists of every level 1 to 4, over all types and per type, in one pass.

    ``levels`` has content_id, content_name and level1_id/level1_name to level4_id/level4_name.
    """
    views = counts.views_by_item(_counted(plays, None, min_seconds), episodes, normalise=False)
    columns = [(f"level{i}_id", f"level{i}_name") for i in range(1, 5)]
    named = levels.select(
        F.col("content_id").alias("item_id"),
        "content_name",
        *[F.col(i) for i, _ in columns],
        *[default_if_blank(F.col(n)).alias(n) for _, n in columns],
    )
    known = one_row_per_key(named, "item_id", F.col("level1_id"))
    placed = level_rows(views.join(known, "item_id"), columns, ["item_id", "content_name", "series_type", "views"])
    grains = with_optional_grain(placed, "series_type")
    group = ["level_no", "level_id", "level_name", "series_type"]
    ranked = top_k(grains, group, _by_views("item_id", truncate=truncate), k)
    keyed = ranked.withColumn("list_key", list_key("Topcontentlist", "5", F.col("level_id"), F.col("series_type")))
    lists = longer_than(one_list_per_key(keyed, ["level_no", "level_name"]), more_than)
    return lists.withColumn(
        "payload",
        top_list_payload(F.col("item_id"), F.col("rank"), F.col("content_name"), F.col("level_name"), F.col("level_id")),
    )


def level1_text(
    plays: DataFrame, episodes: DataFrame, levels: DataFrame, k: int = 15, min_seconds: int = 60
) -> DataFrame:
    """(list_key, items): top ids per level 1, joined by ``#``."""
    views = counts.views_by_item(_counted(plays, None, min_seconds), episodes, normalise=False)
    known = one_row_per_key(
        levels.select(F.col("content_id").alias("item_id"), "level1_id"), "item_id", F.col("level1_id")
    )
    placed = views.join(known, "item_id").where(F.col("level1_id") != "0")
    ranked = top_k(placed, ["level1_id"], _by_views("item_id", "series_type"), k)
    lists = id_lists(ranked, ["level1_id"], "item_id")
    return lists.select(list_key("Topcontentlist", "5", F.col("level1_id")).alias("list_key"), "items")


def catalog_top(plays: DataFrame, elements: DataFrame, k: int = 20) -> DataFrame:
    """OTT top lists per catalogue; the payload carries the views as rank, the position as provider.

    ``elements`` has movie_id, movie_name, catalog_id.
    """
    chosen = plays.where(is_.play_is(F.col("play_type"), F.col("flag4"), is_.PLAY_VOD))
    home = one_row_per_key(
        elements.select(F.col("movie_id").alias("content_id"), "catalog_id", "movie_name"),
        "content_id",
        F.col("catalog_id"),
    )
    views = _counted(chosen).join(home, "content_id").withColumnRenamed("plays", "views")
    ranked = top_k(views, ["catalog_id"], _by_views("content_id"), k)
    return ranked.withColumn("list_key", list_key("Topcontentlist", "3", F.col("catalog_id"), "0")).withColumn(
        "payload", item_payload(F.col("content_id"), F.col("views"), F.col("movie_name"), F.col("rank"))
    )


def district_top(
    plays: DataFrame,
    districts: DataFrame,
    episodes: DataFrame,
    levels: DataFrame,
    k: int = 15,
    truncate: bool = False,
) -> DataFrame:
    """Top lists per district, type and level 1; the payload carries the views as rank.

    ``districts`` has user_id, district. Plays are counted per user before they meet the
    districts, so a heavy user brings one row per content at most.
    """
    counted = counts.play_counts(as_ids(plays, "user_id", "content_id"), "user_id", "content_id")
    return district_top_of(counted, districts, episodes, levels, k, truncate)


def district_top_of(
    counted: DataFrame, districts: DataFrame, episodes: DataFrame, levels: DataFrame, k: int = 15, truncate: bool = False
) -> DataFrame:
    """``district_top`` of plays that are counted already: (user_id, content_id, plays)."""
    placed = (
        counted.join(districts.select("user_id", "district").distinct(), "user_id")
        .groupBy("district", "content_id")
        .agg(F.sum("plays").alias("plays"))
    )
    views = counts.views_by_item(placed, episodes, "district")
    known = one_row_per_key(
        levels.select(F.col("content_id").alias("item_id"), "content_name", "level1_id"), "item_id", F.col("level1_id")
    )
    ranked = top_k(
        views.join(known, "item_id"),
        ["district", "series_type", "level1_id"],
        _by_views("item_id", truncate=truncate),
        k,
    )
    return ranked.withColumn(
        "list_key", list_key(F.col("district"), "5", F.col("series_type"), F.col("level1_id"))
    ).withColumn("payload", item_payload(F.col("item_id"), F.col("views"), F.col("content_name")))
