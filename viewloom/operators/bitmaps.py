"""Seen episodes as bits.

A user's episodes of a series are bits of whole numbers, 64 to a number. Days are merged by OR, so a window of any length is
read from one small row per user, series and day, and an episode that was played on several days counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS = 64


def episode_ordinals(episodes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(content_id, series_id, n_episodes, ordinal): the episode's number in its series, from 0 in the order of ids.

    ``known`` is an earlier result: its numbers stay, and new episodes of a series follow them, so that bits that
    are stored keep their meaning. A series has a handful of episodes.
    """
    rows = episodes.select("content_id", "series_id", "n_episodes")
    of_series = Window.partitionBy("series_id")
    if known is None:
        return rows.withColumn("ordinal", F.row_number().over(of_series.orderBy("content_id")) - 1)
    old = known.select("content_id", "series_id", F.col("ordinal").alias("old"))
    ends = known.groupBy("series_id").agg(F.max("ordinal").alias("end"))
    joined = rows.join(old, ["content_id", "series_id"], "left").join(ends, "series_id", "left")
    after = F.row_number().over(of_series.orderBy(F.col("old").isNotNull(), "content_id")) + F.coalesce("end", F.lit(-1))
    return joined.select("content_id", "series_id", "n_episodes", F.coalesce("old", after).alias("ordinal"))


def seen_bits(plays: DataFrame, ordinals: DataFrame, *keys: str) -> DataFrame:
    """(keys..., series_id, word, bits): what was played, as bits; ``keys`` are usually a user and a day."""
    joined = plays.select(*keys, "content_id").join(ordinals.select("content_id", "series_id", "ordinal"), "content_id")
    bit = F.expr(f"shiftleft(CAST(1 AS BIGINT), CAST(ordinal % {BITS} AS INT))")
    word = F.floor(F.col("ordinal") / BITS).cast("int")
    return joined.groupBy(*keys, "series_id", word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def merged_bits(bits: DataFrame, *keys: str) -> DataFrame:
    """Bits of several days as one row per key, series and word."""
    return bits.groupBy(*keys, "series_id", "word").agg(F.bit_or("bits").alias("bits"))


def progress_of(bits: DataFrame, ordinals: DataFrame, *keys: str) -> DataFrame:
    """(keys..., series_id, total, watched, ratio) of bits that may still be of several days."""
    merged = merged_bits(bits, *keys)
    seen = merged.groupBy(*keys, "series_id").agg(F.sum(F.bit_count("bits")).cast("bigint").alias("watched"))
    totals = ordinals.groupBy("series_id").agg(F.max("n_episodes").cast("bigint").alias("total"))
    return seen.join(totals, "series_id").select(*keys, "series_id", "total", "watched", (F.col("watched") / F.col("total").cast("double")).alias("ratio"))
