"""Live television by the minute.

Programmes are intervals of seconds of the day and moments are points in them (``spans``), so a programme is a few
rows however long it is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.operators.columns import computed
from viewloom.operators.fill import Pool, fill_lists
from viewloom.operators.spans import count_points, join_points
from viewloom.sources.logs import as_date

MINUTES = 1440
ALL = "all"

# Programme types with a list of their own, channels never listed, advert title.
PROGRAM_TYPES = ["电视剧", "电影", "少儿", "综合", "体育", "科教", "财经", "娱乐"]
EXCLUDED_CHANNELS = [
    "cctv1",
    "cctv5",
    "cctv6",
    "cctv3",
    "cctv8",
    "5927c7a6dd31f38686fafa073e2e13bc",
    "590e187a8799b1890175d25ec85ea352",
    "28502a1b6bf5fbe7c6da9241db596237",
    "9291c40ec1cec1281638720c74c7245f",
    "1ce026a774dba0d13dc0cef453248fb7",
    "5dfcaefe6e7203df9fbe61ffd64ed1c4",
    "23ab87816c24f90e5865116512e12c47",
    "20831bb807a45638cfaf81df1122024d",
    "55fc65ef82e92d0e1ccb2b3f200a7529",
    "c8bf387b1824053bdb0423ef806a2227",
    "c39a7a374d888bce3912df71bcb0d580",
    "6a3f44b1abfdfb49ddd051f9e683c86d",
    "dragontv",
    "322fa7b66243b8d0edef9d761a42f263",
    "antv",
]
ADVERT_TITLE = "广告"


def minute_label(minute: Column) -> Column:
    """HHmm of a minute number of the day."""
    hours = F.floor(minute / 60).cast("string")
    return F.concat(F.lpad(hours, 2, "0"), F.lpad((minute % 60).cast("string"), 2, "0"))


def minute_grid(spark: SparkSession, categories: Sequence[str] = (ALL, *PROGRAM_TYPES)) -> DataFrame:
    """(minute, category): every key that gets a list."""
    wanted = F.array(*[F.lit(c) for c in categories])
    return spark.range(MINUTES).select(
        F.col("id").cast("int").alias("minute"), F.explode(wanted).alias("category")
    )


def second_of(ts: Column, day: dt.date | str) -> Column:
    """The first whole second of ``day`` that isn't before ``ts``; negative on earlier days."""
    midnight = F.expr(f"TIMESTAMP_NTZ '{as_date(day)} 00:00:00'")
    return F.ceil(F.timestamp_diff("MICROSECOND", midnight, ts.cast("timestamp_ntz")) / 1000000).cast("bigint")


def _shown_on(schedule: DataFrame, day: dt.date | str) -> DataFrame:
    """Programmes that are on air on ``day``."""
    end_of_day = F.expr(f"TIMESTAMP_NTZ '{as_date(day) + dt.timedelta(days=1)} 00:00:00'")
    midnight = F.expr(f"TIMESTAMP_NTZ '{as_date(day)} 00:00:00'")
    return schedule.where((F.col("start_time") < end_of_day) & (F.col("end_time") > midnight))


def _spans(schedule: DataFrame, day: dt.date | str, *keep: str) -> DataFrame:
    from_, to = (second_of(F.col(c), day) for c in ("start_time", "end_time"))
    return _shown_on(schedule, day).select(*keep, from_.alias("_from"), to.alias("_to"))


def on_air(
    schedule: DataFrame, moments: DataFrame, day: dt.date | str, keep: Sequence[str], at: str = "second", counted: str | None = None
) -> DataFrame:
    """Every row of ``moments`` with every programme on air then: start <= moment < end.

    ``moments`` has the second of ``day`` in the column ``at``; ``keep`` are the columns kept of a programme. With ``counted``,
    programmes that are equal in ``keep`` are one row, in which the column ``counted`` is how many of them have a value there;
    they are counted by segment, so no moment meets single programmes.
    """
    if counted is None:
        return join_points(_spans(schedule, day, *keep), moments, "_from", "_to", at).drop("_from", "_to")
    return count_points(_spans(schedule, day, *keep, counted), moments, "_from", "_to", at, keep, F.count(counted), counted)


#: On-air rows of a task: the programmes that make them and the groups that they come into are dealt by this number.
TASK_ROWS = 500_000


def _tasks(schedule: DataFrame, day: dt.date | str) -> int:
    """As many tasks as the rows of ``on_air_minutes`` need."""
    spans = _spans(schedule, day)
    minute = [F.ceil(F.least(F.greatest(F.col(c), F.lit(0)), F.lit(MINUTES * 60)) / 60) for c in ("_from", "_to")]
    rows = spans.agg(F.sum(F.greatest(minute[1] - minute[0], F.lit(0)))).first()[0] or 0
    return max(8, -(-rows // TASK_ROWS))


def on_air_minutes(schedule: DataFrame, day: dt.date | str, keep: Sequence[str]) -> DataFrame:
    """One row per programme and minute of ``day`` with start <= minute < end."""
    minutes = schedule.sparkSession.range(MINUTES).select(F.col("id").cast("int").alias("minute"), (F.col("id") * 60).alias("second"))
    return on_air(schedule, minutes, day, keep).drop("second")


def listable(schedule: DataFrame, excluded: Sequence[str] = EXCLUDED_CHANNELS) -> DataFrame:
    """Programmes of channels that may be listed, without adverts."""
    return schedule.where(~F.col("channel_id").isin(list(excluded)) & (F.col("wiki_title") != ADVERT_TITLE))


def ratings_of(audience: DataFrame, day: dt.date | str, minute_time: str | None = None) -> DataFrame:
    """(service_id, minute_time, tv_rating) of a day: one row per channel and minute."""
    rows = audience.where(F.col("date_time") == F.lit(as_date(day)))
    if minute_time is not None:
        rows = rows.where(F.col("minute_time") == minute_time)
    return rows.groupBy(F.col("channel").alias("service_id"), "minute_time").agg(
        F.max("tv_rating").alias("tv_rating")
    )


def rated_channels(
    schedule: DataFrame,
    audience: DataFrame,
    as_of: dt.date | str,
    program_types: Sequence[str] = PROGRAM_TYPES,
    excluded: Sequence[str] = EXCLUDED_CHANNELS,
    distinct: bool = True,
) -> DataFrame:
    """(minute, category, channel_id, tv_rating): channels on air and their audience of a week ago."""
    day = as_date(as_of)
    shown = _shown_on(listable(schedule, excluded), day)
    tasks = _tasks(shown, day)
    # A day's programmes may lie in one file; they are few until they meet their minutes.
    shown = shown.repartition(tasks, "channel_id", "start_time")
    minutes = on_air_minutes(shown, day, ["channel_id", "service_id", "program_type"])
    rated = ratings_of(audience, day - dt.timedelta(days=7))
    joined = minutes.withColumn("minute_time", minute_label(F.col("minute"))).join(
        rated, ["service_id", "minute_time"], "left"
    )
    own = F.when(F.col("program_type").isin(list(program_types)), F.col("program_type"))
    by_category = joined.select(
        "minute",
        "channel_id",
        "tv_rating",
        F.explode(F.array_compact(F.array(F.lit(ALL), own))).alias("category"),
    )
    # All that follows goes by minute and category, so the rows move once and the tasks follow their number.
    by_category = by_category.repartition(2 * tasks, "minute", "category")
    if not distinct:
        return by_category.select("minute", "category", "channel_id", "tv_rating")
    return by_category.groupBy("minute", "category", "channel_id").agg(F.max("tv_rating").alias("tv_rating"))


def live_lists(schedule: DataFrame, audience: DataFrame, as_of: dt.date | str, *settings, **options) -> DataFrame:
    """``rated_channels`` with rank: the best audience first, unrated channels last."""
    order = Window.partitionBy("minute", "category").orderBy(F.desc_nulls_last("tv_rating"), F.asc("channel_id"))
    rated = rated_channels(schedule, audience, as_of, *settings, **options)
    return rated.withColumn("rank", F.row_number().over(order))


def minute_objects(grid: DataFrame, rated: DataFrame, pool: Pool, target: int, seed: int | str) -> DataFrame:
    """(minute, category, n_live, channels, vods): channels on air, best first, and the filler that brings them to ``target``.

    ``rated`` is the result of ``rated_channels``. An object holds every channel of its minute, so that is what a task collects.
    """
    # Numbers sort by falling rating, unrated channels after all.
    entry = F.struct(F.col("tv_rating").isNull().alias("unrated"), (-F.col("tv_rating")).alias("turn"), "channel_id")
    channels = rated.groupBy("minute", "category").agg(F.array_sort(F.collect_list(entry)).alias("_live"))
    joined = grid.join(channels, ["minute", "category"], "left")
    none = F.array().cast("array<string>")
    listed = joined.select(
        "minute", "category", F.coalesce(F.transform("_live", lambda x: x["channel_id"]), none).alias("channels")
    )
    filled = fill_lists(listed, pool, ["minute", "category"], "channels", target, seed, other_ids=True)
    return filled.select(
        "minute", "category", F.size("channels").alias("n_live"), "channels", F.col("fill").alias("vods")
    )


def _has(column: str, *words: str) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | F.col(column).contains(word)
    return test


# The fields of a published filler and the library columns they show.
FILM_LIBRARY_FIELDS = {"name_cn": "name", "mediaid": "media_id", "index": "ind", "p_pic": "image"}
CATALOGUE_FIELDS = {
    "categoryCode": "category_code",
    "categoryItemCode": "category_item_code",
    "categoryName": "category_name",
    "pCode": "media_id",
    "pType": "ptype",
    "pName": "name",
    "type": "type",
    "bigImage1": "big_image",
}


def film_library_fillers() -> dict[str, Column]:
    """Filler choice per category in the film library (mtype, tags, plots, adword)."""
    kind, variety = F.col("mtype"), F.col("mtype") == "variety"
    documentary = _has("tags", "纪实")
    return {
        "电视剧": kind == "tv",
        "电影": kind == "movie",
        "少儿": kind == "cartoon",
        "综合": variety,
        "体育": (kind != "cartoon")
        & (kind != "tv")
        & (_has("plots", "运动") | _has("tags", "运动"))
        & ~_has("tags", "爱情", "纪实", "恐怖", "惊悚"),
        "科教": _has("tags", "科教") & variety,
        "财经": (kind != "cartoon") & (_has("plots", "证券", "股市", "房地产") | _has("adword", "股市")),
        # The reality shows count whatever their kind is.
        "娱乐": (variety & ~documentary) | (documentary & _has("tags", "真人秀")),
        ALL: variety,
    }


def catalogue_fillers(year: int = 2015) -> dict[str, Column]:
    """Filler choice per category in the programme catalogue (ptype, type, year, tags, images)."""
    kind, film, recent = F.col("ptype"), F.col("type") == 0, F.col("year") == year
    item, image = F.col("category_item_code") != "", F.col("big_image") != ""
    documentary = film & (kind == "纪实") & recent
    return {
        "电视剧": (kind == "电视剧") & recent,
        "电影": film & (kind == "电影") & recent,
        "少儿": (kind == "少儿") & item,
        "综合": documentary,
        "体育": film & (kind == "体育") & image & item,
        "科教": film & _has("tags", "自然") & image & recent,
        "财经": film & (kind == "财经") & image & recent,
        "娱乐": film & (kind == "娱乐") & image & recent,
        ALL: documentary,
    }


def filler_pool(vods: DataFrame, choices: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """(category, keep...): one pass over the library, a row per category that accepts it."""
    accepted = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in choices.items()]))
    return vods.select(F.explode(accepted).alias("category"), *keep)
