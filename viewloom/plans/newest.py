"""Newest-content lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.functions.payloads import item_payload, list_key
from viewloom.functions.scalars import series_flag
from viewloom.operators.ranking import renumber, top_k

OVERALL = "0"


def _lists(
    rows: DataFrame, overall: int, per_level: int, platform: str, item: str, name: str, limit_scope: str
) -> DataFrame:
    """Rank (level_id, series_type, item, name, newest) rows; the limit comes before the split by type."""
    if limit_scope not in ("all", "type"):
        raise ValueError(f"limit_scope must be 'all' or 'type', not {limit_scope!r}")
    by_type = ["series_type"] if limit_scope == "type" else []
    order = [F.desc_nulls_last("newest"), F.asc(item)]
    limit = F.when(F.col("level_id") == OVERALL, overall).otherwise(per_level)
    limited = top_k(rows, ["level_id", *by_type], order, max(overall, per_level)).where(F.col("rank") <= limit)
    lists = renumber(limited, ["level_id", "series_type"], order)
    return lists.withColumn(
        "list_key", list_key("Newcontentlist", platform, F.col("level_id"), F.col("series_type"))
    ).withColumn("payload", item_payload(F.col(item), F.col("rank"), F.col(name)))


def _known_level(level):
    """One-character levels (0 or blank) would take the place of the overall list."""
    return F.length(F.trim(level)) > 1


def box_newest(relation: DataFrame, k: int = 15, limit_scope: str = "all") -> DataFrame:
    """Newest contents overall and per level id, whichever of the six levels it is, one pass for all.

    ``relation`` has content_id, content_name, series_type, resource_time, level1_id to level6_id.
    """
    levels = F.array(*[F.col(f"level{i}_id").cast("string") for i in range(1, 7)])
    filled = F.array_distinct(F.filter(levels, _known_level))
    rows = (
        relation.select(
            "content_id",
            "content_name",
            F.col("series_type").cast("string").alias("series_type"),
            "resource_time",
            F.explode(F.concat(F.array(F.lit(OVERALL)), filled)).alias("level_id"),
        )
        .groupBy("level_id", "series_type", "content_id", "content_name")
        .agg(F.max("resource_time").alias("newest"))
    )
    return _lists(rows, k, k, "5", "content_id", "content_name", limit_scope)


def ott_newest(elements: DataFrame, k: int = 15, limit_scope: str = "all") -> DataFrame:
    """The same for OTT by year: twice as many overall, k per catalogue.

    ``elements`` has movie_id, movie_name, type_id, catalog_id, year.
    """
    catalog = F.col("catalog_id").cast("string")
    lists = F.array_compact(F.array(F.lit(OVERALL), F.when(_known_level(catalog), catalog)))
    rows = (
        elements.select(
            "movie_id",
            "movie_name",
            series_flag(F.col("type_id").cast("string")).cast("string").alias("series_type"),
            "year",
            F.explode(lists).alias("level_id"),
        )
        .groupBy("level_id", "series_type", "movie_id", "movie_name")
        .agg(F.max("year").alias("newest"))
    )
    return _lists(rows, 2 * k, k, "3", "movie_id", "movie_name", limit_scope)
