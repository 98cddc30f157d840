"""Metadata tables and the lookups made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.functions.predicates import is_series_catalog
from viewloom.functions.scalars import split_ids


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A catalogue table, or the Parquet folder of the same name."""
    return spark.read.parquet(f"{folder}/{name}.parquet") if folder else spark.table(name)


def id_bounds_query(table: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"


def read_jdbc_by_id(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    num_partitions: int = 10,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Range-partitioned database scan whose bounds are the ids that exist, ends included."""
    properties = properties or {}
    bounds = spark.read.jdbc(url, id_bounds_query(table, column), properties=properties).first()
    if bounds is None or bounds[0] is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=int(bounds[0]),
        upperBound=int(bounds[1]) + 1,
        numPartitions=num_partitions,
        properties=properties,
    )


def one_row_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """Lookup table: for every key the row that is last in ``order`` (ties: largest values)."""
    others = [c for c in df.columns if c != key]
    best = F.max(F.struct(order.alias("_order"), *others)).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in others])


def series_catalogs(catalog: DataFrame) -> DataFrame:
    """Catalogue rows that are series with episodes."""
    return catalog.where(is_series_catalog(F.col("type"), F.col("sort_index")))


def episode_map(catalog: DataFrame) -> DataFrame:
    """(content_id, series_id, n_episodes, series_name), one row per episode.

    An episode listed by several series belongs to the one with the largest id.
    """
    listed = (
        series_catalogs(catalog)
        .select(
            F.col("catalog_id").alias("series_id"),
            F.col("name").alias("series_name"),
            split_ids(F.col("sort_index")).alias("_episodes"),
        )
        .select(
            "series_id",
            "series_name",
            F.size("_episodes").alias("n_episodes"),
            F.explode("_episodes").alias("_episode"),
        )
    )
    episodes = listed.select(
        F.col("_episode").try_cast("bigint").alias("content_id"), "series_id", "n_episodes", "series_name"
    ).where(F.col("content_id").isNotNull())
    return one_row_per_key(episodes, "content_id", F.col("series_id"))


def catalog_members(catalog: DataFrame) -> DataFrame:
    """(catalog_id, content_id, position): the children lists in long form."""
    return (
        catalog.where(F.col("sort_index").isNotNull())
        .select("catalog_id", F.posexplode(split_ids(F.col("sort_index"))).alias("position", "_child"))
        .select("catalog_id", F.col("_child").try_cast("bigint").alias("content_id"), "position")
        .where(F.col("content_id").isNotNull())
    )


def film_names(elements: DataFrame, allowed: Column | None = None) -> DataFrame:
    """(content_id, content_name), one row per film."""
    films = elements if allowed is None else elements.where(allowed)
    return one_row_per_key(films.select("content_id", "content_name"), "content_id", F.col("content_name"))


def relate_content(relation: DataFrame, *details: DataFrame) -> DataFrame:
    """Level rows joined with the element and the series details, as one table."""
    joined = [relation.join(d, "content_id") for d in details]
    result = joined[0]
    for other in joined[1:]:
        result = result.unionByName(other)
    return result


def level_rows(content: DataFrame, levels: list[tuple[str, str]], keep: list[str]) -> DataFrame:
    """One row per content and filled level: (keep..., level_no, level_id, level_name)."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("level_no"),
                F.col(id_col).cast("string").alias("level_id"),
                F.col(name_col).cast("string").alias("level_name"),
            )
            for i, (id_col, name_col) in enumerate(levels)
        ]
    )
    return (
        content.select(*keep, F.explode(pairs).alias("_level"))
        .select(*keep, "_level.level_no", "_level.level_id", "_level.level_name")
        .where((F.col("level_id") != "0") & (F.trim("level_id") != ""))
    )
