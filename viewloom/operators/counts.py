"""Play counts and episode roll-up.

Raw log rows are never shuffled as they are: the first step is always a count with map-side
combine, so a content or user that holds a large share of the log shrinks to a few rows per
task before it moves. Lookups are joined to the counts, not to the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def play_counts(plays: DataFrame, *keys: str) -> DataFrame:
    """Plays per key combination, in column ``plays``."""
    return plays.groupBy(*keys).agg(F.count(F.lit(1)).alias("plays"))


def series_or_self(counts: DataFrame, episodes: DataFrame, *keys: str) -> DataFrame:
    """Counts per (keys..., item_id): episodes count for their series, anything else for itself."""
    lookup = episodes.select("content_id", "series_id")
    return (
        counts.join(lookup, "content_id", "left")
        .withColumn("item_id", F.coalesce("series_id", "content_id"))
        .groupBy(*keys, "item_id")
        .agg(F.sum("plays").alias("plays"))
    )


def views_by_item(
    counts: DataFrame,
    episodes: DataFrame,
    *keys: str,
    films: DataFrame | None = None,
    normalise: bool = True,
) -> DataFrame:
    """(keys..., item_id, series_type, views[, item_name]) from counts per (keys..., content_id).

    A series' plays are divided by its number of episodes when ``normalise`` is set. With
    ``films``, contents that are neither an episode nor a known film are dropped and the names
    are attached; without it they are kept as films.
    """
    joined = counts.join(episodes, "content_id", "left")
    is_series = F.col("series_id").isNotNull()
    item = F.coalesce("series_id", "content_id").alias("item_id")
    kind = F.when(is_series, F.lit(1)).otherwise(F.lit(0)).alias("series_type")
    divisor = F.coalesce("n_episodes", F.lit(1)) if normalise else F.lit(1)
    names: list[Column] = []
    if films is not None:
        names = [F.coalesce("series_name", "content_name").alias("item_name")]
        joined = joined.join(films, "content_id", "left").where(is_series | F.col("content_name").isNotNull())
    prepared = joined.select(*keys, item, kind, divisor.alias("_divisor"), "plays", *names)
    by = [*keys, "item_id", "series_type", "_divisor", *(["item_name"] if names else [])]
    return (
        prepared.groupBy(*by)
        .agg(F.sum("plays").alias("_plays"))
        .withColumn("views", F.col("_plays") / F.col("_divisor").cast("double"))
        .drop("_plays", "_divisor")
    )


def within(plays: DataFrame, members: DataFrame, on: str = "content_id") -> DataFrame:
    """Rows whose id is a member."""
    return plays.join(members.select(on), on, "left_semi")


def series_progress(plays: DataFrame, episodes: DataFrame) -> DataFrame:
    """Distinct episodes seen per (user, series), the series' length and their ratio."""
    seen = plays.select("user_id", "content_id").distinct()
    lookup = episodes.select("content_id", "series_id", F.col("n_episodes").cast("bigint").alias("total"))
    return (
        seen.join(lookup, "content_id")
        .groupBy("user_id", "series_id", "total")
        .agg(F.count(F.lit(1)).alias("watched"))
        .withColumn("ratio", F.col("watched") / F.col("total").cast("double"))
    )


def share_histogram(df: DataFrame, bin_col: Column) -> DataFrame:
    """(bin, n, total, share): the window runs over the handful of bins, not over the rows."""
    counted = df.groupBy(bin_col.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("total", F.sum("n").over(Window.partitionBy())).withColumn(
        "share", F.col("n") / F.col("total").cast("double")
    )
