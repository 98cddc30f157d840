"""JSON payloads of published list rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_or_empty(col: Column | None) -> Column:
    """Every field is text, unknown ones are empty (NULL would drop the field)."""
    if col is None:
        return F.lit("")
    return F.coalesce(col.cast("string"), F.lit(""))


def _object(**fields: Column | None) -> Column:
    return F.to_json(F.struct(*[text_or_empty(col).alias(name) for name, col in fields.items()]))


def item_payload(
    movie_id: Column,
    rank: Column,
    name: Column | None = None,
    provider_id: Column | None = None,
) -> Column:
    """Six-field list row."""
    return _object(
        assetId=None, assetname=name, assetpic=None, movieID=movie_id, providerId=provider_id, rank=rank
    )


def top_list_payload(
    movie_id: Column,
    rank: Column,
    name: Column | None = None,
    parent_name: Column | None = None,
    parent_id: Column | None = None,
) -> Column:
    """Eight-field list row with the level the list belongs to."""
    return _object(
        assetId=None,
        assetname=name,
        assetpic=None,
        movieID=movie_id,
        parentName=parent_name,
        parentid=parent_id,
        providerId=None,
        rank=rank,
    )


def channel_payload(channel_id: Column, name: Column, picture: Column, rank: Column) -> Column:
    return _object(channelId=channel_id, channelname=name, channelpic=picture, rank=rank)


def live_payload(channels: Column, vods: Column) -> Column:
    """One object with the live channels and the filler programmes of a key."""
    return F.to_json(F.struct(channels.alias("rec_livelist"), vods.alias("rec_vodlist")))


def list_key(*parts: Column | str) -> Column:
    """Key of a published list: its parts joined by underscores (plain strings are literals)."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat_ws("_", *cols)
