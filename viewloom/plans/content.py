"""Lists of contents that share attributes with a target."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions import predicates as is_
from viewloom.functions.payloads import item_payload, list_key
from viewloom.functions.scalars import blank_to_null, day_of, draw_order, first_code
from viewloom.operators import fill
from viewloom.operators.ranking import at_least, id_lists, top_k, top_k_if_more
from viewloom.operators.shortlist import newest_first, recommend_by_draw, recommend_by_order
from viewloom.sinks.lists import episode_owners, one_list_per_key

FILM_KEYS = ["level1_id", "genre", "series_type", "level2_id"]
FILM_KEYS_COARSE = ["level1_id", "genre", "series_type"]
SCHOOL_KEYS = ["level1_id", "level2_id", "level3_id", "level4_id", "series_type"]


def attributes(content: DataFrame, root: str | None = None) -> DataFrame:
    """Content rows with a known genre; blanks are NULL and the date is a date."""
    rows = content if root is None else content.where(F.col("level1_id") == root)
    return rows.select(
        "content_id",
        "title",
        blank_to_null(F.col("genre")).alias("genre"),
        day_of(blank_to_null(F.col("create_time"))).alias("day"),
        blank_to_null(F.col("country")).alias("country"),
        "series_type",
        "level1_id",
        "level2_id",
        "level3_id",
        "level4_id",
    ).where(F.col("genre").isNotNull())


def _is_series() -> Column:
    """An unknown type counts as film."""
    return F.col("series_type").eqNullSafe("1")


def _complete_film() -> Column:
    return ~_is_series() & is_.has_date_and_country(F.col("day"), F.col("country"))


def _group(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per content and group, with its latest date."""
    return rows.groupBy(*keys, "content_id", "title").agg(F.max("day").alias("day"))


def _recommend(
    rows: DataFrame,
    keys: Sequence[str],
    as_of: dt.date | str,
    k: int,
    years: int | None,
    seed: int | None,
    series: DataFrame | None = None,
) -> DataFrame:
    """Newest first, or a draw when a seed is given; only the recommended side must be recent.

    With ``series``, the ids that own each list are attached to the targets, in ``owners``.
    """
    targets = rows if series is None else _with_owners(rows, series)
    recent = rows.where(is_.newer_than(F.col("day"), as_of, years)) if years is not None else rows
    order = [newest_first(F.col("day")), F.col("content_id")]
    if seed is None:
        return recommend_by_order(targets, recent, keys, order, k, fields=["title", "day"])
    return recommend_by_draw(targets, recent, keys, order, k, seed, fields=["title", "day"])


def _with_owners(rows: DataFrame, series: DataFrame) -> DataFrame:
    """A film owns its list; a series' list belongs to the series and its episodes, if it has any."""
    joined = rows.join(episode_owners(series), "content_id", "left")
    own = F.when(~_is_series(), F.array("content_id"))
    return joined.withColumn("owners", F.coalesce(own, F.col("owners")))


def related(
    rows: DataFrame,
    as_of: dt.date | str,
    k: int = 15,
    years: int | None = 2,
    seed: int | None = None,
    keys: Sequence[str] = FILM_KEYS,
    series: DataFrame | None = None,
) -> DataFrame:
    """Films and series among their like, in one pass.

    Films with date and country go with films of the same country, films that lack one of them
    with each other, and series with series: ``same_country`` is NULL for the last two, and the
    type is one of the keys.
    """
    placed = rows.where(~F.col("level1_id").eqNullSafe(is_.SCHOOL_LEVEL)).withColumn(
        "same_country", F.when(_complete_film(), F.col("country"))
    )
    by = [*keys, "same_country"]
    return _recommend(_group(placed, by), by, as_of, k, years, seed, series)


def films_same_country(rows: DataFrame, as_of: dt.date | str, **options) -> DataFrame:
    """Films with date and country, among films of the same country."""
    return related(rows.where(_complete_film()), as_of, **options)


def films_missing_attributes(rows: DataFrame, as_of: dt.date | str, **options) -> DataFrame:
    """Films without date or country, among their like."""
    chosen = ~_is_series() & is_.lacks_date_or_country(F.col("day"), F.col("country"))
    return related(rows.where(chosen), as_of, **options)


def series_lists(rows: DataFrame, as_of: dt.date | str, **options) -> DataFrame:
    """Series among series."""
    return related(rows.where(_is_series()), as_of, **options)


def school_lists(
    rows: DataFrame,
    as_of: dt.date | str,
    k: int = 15,
    years: int | None = 2,
    seed: int | None = None,
    school: str = is_.SCHOOL_LEVEL,
) -> DataFrame:
    """School contents among contents of the same four levels."""
    lessons = rows.where((F.col("level1_id") == school) & (F.col("level2_id") != "0"))
    return _recommend(_group(lessons, SCHOOL_KEYS), SCHOOL_KEYS, as_of, k, years, seed)


def box_lists(
    content: DataFrame,
    series: DataFrame,
    as_of: dt.date | str,
    k: int = 15,
    years: int | None = 2,
    seed: int | None = 42,
    keys: Sequence[str] = FILM_KEYS,
    root: str | None = None,
    school: bool = False,
    film_more_than: int = 5,
    series_more_than: int = 5,
    key_by_type: bool = False,
) -> DataFrame:
    """(list_key, owner_id, rank, rec_content_id, rec_title, payload) for films, series and episodes.

    Variants are arguments: the current form draws at random (``seed``); the one-root form adds
    ``root``, k=20 and a film gate of 0; the earliest uses coarse keys, dates instead of draws
    (seed=None), years=None, ``school`` and no gate; the one in between years=5 and ``school``.
    """
    rows = attributes(content, root)
    by = ["_step", "content_id", "level1_id", "level2_id", "genre", "series_type"]
    fields = [*by[1:], "same_country", "rank", "rec_count", "rec_content_id", "rec_title"]
    lists = _owned(related(rows, as_of, k, years, seed, keys, series), fields)
    # Jobs publish in this order, and the last list that passes its gate stays.
    step = F.when(_is_series(), 2).when(F.col("same_country").isNull(), 1).otherwise(0)
    lists = lists.withColumn("_step", step)
    if school:
        taught = _fields(school_lists(rows, as_of, k, years, seed), fields)
        lists = lists.unionByName(
            taught.withColumn("owner_id", F.col("content_id")).withColumn("_step", F.lit(3))
        )
    gate = F.when(F.col("_step") == 2, series_more_than).otherwise(film_more_than)
    kind = F.col("series_type") if key_by_type else F.lit("0")
    keyed = lists.where(F.col("rec_count") > gate).withColumn(
        "list_key", list_key(F.col("owner_id"), "5", F.col("level1_id"), kind)
    )
    payload = item_payload(F.col("rec_content_id"), F.col("rank"), F.col("rec_title"))
    return one_list_per_key(keyed, by).select(
        "list_key", "owner_id", "rank", "rec_content_id", "rec_title", payload.alias("payload")
    )


def _owned(lists: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One copy of each list per owner (column ``owner_id``)."""
    return _fields(lists, [*fields, "owners"]).withColumn("owner_id", F.explode("owners")).drop("owners")


def _fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    known = set(df.columns)
    return df.select(*[F.col(n) if n in known else F.lit(None).cast("string").alias(n) for n in names])


def text_lists(
    content: DataFrame, series: DataFrame, as_of: dt.date | str, k: int = 15, years: int = 2, seed: int | None = 42
) -> DataFrame:
    """(owner_id, items): films, series and their episodes with ``#``-joined ids."""
    rows = attributes(content)
    group = ["content_id", *FILM_KEYS, "same_country"]
    lists = _owned(related(rows, as_of, k, years, seed, series=series), [*group, "rank", "rec_content_id"])
    return id_lists(lists, ["owner_id", *group], "rec_content_id").select("owner_id", "items")


def ott_lists(elements: DataFrame, k: int = 15, minimum: int = 100) -> DataFrame:
    """(movie_id, catalog_id, rank, rec_movie_id, rec_movie_name) by type and first drama code.

    School elements go by type and catalogue instead. ``elements`` has movie_id, movie_name,
    catalog_id, type_id and drama_type_id; nothing is listed unless there are more than
    ``minimum`` of them.
    """
    typed = elements.where(is_.valid_ids(F.col("type_id"))).withColumn(
        "drama_type_id", blank_to_null(F.col("drama_type_id"))
    )
    rows = at_least(typed.where(F.col("drama_type_id").isNotNull()), minimum)
    is_school = F.col("type_id") == is_.OTT_SCHOOL_TYPE
    code = F.when(is_school, F.col("catalog_id").cast("string")).otherwise(first_code(F.col("drama_type_id")))
    keys = ["type_id", "code"]
    rows = rows.withColumn("code", code)
    items = rows.groupBy(*keys, "movie_id").agg(F.max("movie_name").alias("movie_name"))
    targets = rows.select(*keys, "movie_id", "catalog_id").distinct()
    lists = recommend_by_order(
        targets, items, keys, [F.col("movie_id")], k, item="movie_id", title=None, fields=["movie_name"]
    )
    return lists.withColumn("list_key", list_key(F.col("movie_id"), "3", "0", F.col("catalog_id"))).withColumn(
        "payload", item_payload(F.col("rec_movie_id"), F.col("rank"), F.col("rec_movie_name"))
    )


def cinema_relatives(members: DataFrame, names: DataFrame, k: int = 20, more_than: int = 2, seed: int = 42) -> DataFrame:
    """(content_id, rank, rec_content_id, rec_name): films of the same catalogues, for lists of more than ``more_than``.

    ``members`` has catalog_id, content_id; ``names`` content_id, content_name. A film in several
    catalogues draws from all of them.
    """
    rows = members.select("catalog_id", "content_id").distinct().join(names, "content_id", "left")
    drawn = recommend_by_draw(
        rows,
        rows,
        ["catalog_id"],
        [F.col("content_id")],
        k,
        seed,
        title="content_name",
        fields=["content_name"],
        unique_titles=False,
    )
    merged = drawn.groupBy("content_id", "rec_content_id").agg(F.max("rec_content_name").alias("rec_name"))
    order = [draw_order(seed, F.col("content_id"), F.col("rec_content_id")), F.asc("rec_content_id")]
    chosen = top_k_if_more(merged, ["content_id"], order, k, more_than)
    return chosen.select("content_id", "rank", "rec_content_id", "rec_name")


def cinema_lists(members: DataFrame, names: DataFrame, k: int = 20, more_than: int = 2, seed: int = 42) -> DataFrame:
    """(content_id, rank, rec_content_id, rec_name, source): ``cinema_relatives``, filled up to k from all films."""
    entry = F.struct("rank", "rec_content_id", "rec_name")
    related_ = cinema_relatives(members, names, k, more_than, seed)
    lists = related_.groupBy("content_id").agg(F.array_sort(F.collect_list(entry)).alias("_recs"))
    lists = lists.withColumn("_ids", F.transform("_recs", lambda x: x["rec_content_id"]))
    pool = fill.pool_of(members, "content_id")
    filled = fill.fill_lists(lists, pool, ["content_id"], "_ids", k, seed, exclude=["content_id"])
    own = F.transform(
        "_recs",
        lambda x: F.struct(
            x["rec_content_id"].alias("rec_content_id"),
            x["rec_name"].alias("rec_name"),
            F.lit("catalog").alias("source"),
        ),
    )
    extra = F.transform(
        "fill",
        lambda x: F.struct(
            x["content_id"].alias("rec_content_id"),
            F.lit(None).cast("string").alias("rec_name"),
            F.lit("pool").alias("source"),
        ),
    )
    return filled.select("content_id", F.posexplode(F.concat(own, extra)).alias("_at", "_row")).select(
        "content_id", (F.col("_at") + 1).alias("rank"), "_row.*"
    )


def web_lists(catalog: DataFrame, elements: DataFrame, k: int = 20, more_than: int = 20) -> DataFrame:
    """(movie_id, level1_id, rank, rec_movie_id) for movies with more than ``more_than`` relatives.

    ``catalog`` has level1_id, level2_id, movie_id; ``elements`` movie_id, resource_code.
    """
    ids = ["level1_id", "level2_id", "movie_id"]
    rows = catalog.where(is_.valid_ids(*[F.col(c) for c in ids])).select(*ids).distinct()
    reach = max(k, more_than + 1)
    listed = recommend_by_order(
        rows, rows, ["level1_id", "level2_id"], [F.col("movie_id")], reach, item="movie_id", title=None
    )
    merged = listed.select("level1_id", "movie_id", "rec_movie_id").distinct()
    chosen = top_k_if_more(merged, ["level1_id", "movie_id"], [F.asc("rec_movie_id")], k, more_than)
    known = elements.where(is_.valid_ids(F.col("movie_id"), F.col("resource_code"))).select("movie_id")
    lists = chosen.join(known, "movie_id", "left_semi")
    return lists.withColumn("list_key", list_key(F.col("movie_id"), "7", F.col("level1_id"), "0")).withColumn(
        "payload", item_payload(F.col("rec_movie_id"), F.col("rank"))
    )
