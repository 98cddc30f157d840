"""Live-channel lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.functions.payloads import channel_payload, list_key, live_payload, text_or_empty
from viewloom.operators import airtime, fill
from viewloom.operators.ranking import top_k
from viewloom.sources.logs import as_date

LIST_SIZE = 18


def channel_ranking(channels: DataFrame, audience: DataFrame, as_of: dt.date | str, k: int = 20) -> DataFrame:
    """Channels by last week's noon audience; unrated channels last.

    ``channels`` has service_id, channel_id, channel_name, channel_image.
    """
    noon = airtime.ratings_of(audience, as_date(as_of) - dt.timedelta(days=7), "1200").drop("minute_time")
    rated = channels.join(noon, "service_id", "left")
    ranked = top_k(rated, [], [F.desc_nulls_last("tv_rating"), F.asc("channel_id")], k)
    return ranked.withColumn("list_key", F.lit("Broadcast_1_1_1")).withColumn(
        "payload",
        channel_payload(F.col("channel_id"), F.col("channel_name"), F.col("channel_image"), F.col("rank")),
    )


def minute_lists(
    schedule: DataFrame,
    audience: DataFrame,
    fillers: DataFrame,
    as_of: dt.date | str,
    fields: Mapping[str, str] = airtime.FILM_LIBRARY_FIELDS,
    target: int = LIST_SIZE,
    seed: int = 42,
    program_types: Sequence[str] = airtime.PROGRAM_TYPES,
    excluded: Sequence[str] = airtime.EXCLUDED_CHANNELS,
    distinct: bool = True,
) -> DataFrame:
    """(list_key, minute, category, n_live, channels, vods, payload) for each minute and category of the day.

    ``fillers`` has category, media_id and the columns that ``fields`` names for the texts of a published filler; short
    live lists get as many fillers as they lack, live lists are never cut.
    """
    grid = airtime.minute_grid(schedule.sparkSession, [airtime.ALL, *program_types])
    rated = airtime.rated_channels(schedule, audience, as_of, program_types, excluded, distinct)
    columns = [c for c in dict.fromkeys(fields.values()) if c != "media_id"]
    pool = fill.pool_of(fillers, "media_id", ["category"], columns)
    objects = airtime.minute_objects(grid, rated, pool, target, seed)
    shown = F.transform("vods", lambda v: F.struct(*[text_or_empty(v[column]).alias(name) for name, column in fields.items()]))
    label = airtime.minute_label(F.col("minute"))
    return (
        objects.withColumn("vods", shown)
        .withColumn("list_key", list_key(label, F.col("category")))
        .withColumn("payload", live_payload(F.col("channels"), F.col("vods")))
    )
