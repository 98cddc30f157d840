"""Positions and schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

# Positions read from each daily log line.
LOG_LAYOUTS = {
    "xor_vod": {"content_id": 0, "watch_seconds": 5, "user_id": 11},
    "vsp_vod": {"content_id": 5, "user_id": 6, "product_key": 7},
    "ott_play": {"content_id": 3, "flag4": 4, "play_type": 5, "user_id": 7},
}

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("rating", T.DoubleType()),
    ]
)

COMPLETION = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("series_id", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("watched", T.LongType()),
        T.StructField("ratio", T.DoubleType()),
    ]
)
