"""Spark side of the registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.functions import predicates as is_
from viewloom.functions import scalars as sc
from viewloom.functions.payloads import channel_payload, item_payload, top_list_payload
from viewloom.operators import airtime, bitmaps, deltas, factors, fill, hierarchy, treeindex
from viewloom.operators import cooccurrence as co
from viewloom.operators import counts as cnt
from viewloom.operators.ranking import drop_repeated_names, top_k
from viewloom.plans import behavior, content, live, newest, popularity, reports
from viewloom.plans.publish import publish_job
from viewloom.plans.rolling import RollingCounts
from viewloom.session import cut_lineage, ensure_checkpoint_dir
from viewloom.sinks.lists import longer_than, replace_unless_shorter, to_episodes
from viewloom.sinks.outside import publish_to, read_store
from viewloom.sinks.versions import ListStore
from viewloom.sources import bucketed, logs, ranges
from viewloom.sources.logs import in_timestamp_window
from viewloom.sources.metadata import catalog_members, episode_map, film_names, level_rows, relate_content
from workload import standins as st
from workload.standins import AS_OF, EVENTS_AS_OF, LIVE_DAY, frame, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _event_plays(spark, sf, span=30):
    plays = frame(spark, sf, "event_plays")
    return plays.where(in_timestamp_window(F.col("ts"), EVENTS_AS_OF, span))


def _event_catalog(spark, sf):
    return st.series_catalog(frame(spark, sf, "event_members"))


def _part_catalog(spark, sf):
    return st.series_catalog(frame(spark, sf, "part_members"))


def _part_films(spark, sf):
    return film_names(frame(spark, sf, "part_films"), is_.genre_allowed(F.col("genre")))


def _series(spark, sf):
    return _part_catalog(spark, sf).select(F.col("catalog_id").alias("content_id"), "sort_index")


# Sources, cleaning, lookups


@query
def scan_date_window(spark, sf):
    events = table(spark, sf, "events")
    kept = events.where(in_timestamp_window(F.col("ts"), EVENTS_AS_OF, 10))
    return kept.select("event_id", "user_id", "event_type")


@query
def valid_ids(spark, sf):
    plays = frame(spark, sf, "event_plays")
    return reports.as_ids(plays, "user_id", "content_id", max_length=3).select("user_id", "content_id", "flag4")


@query
def blank_as_null(spark, sf):
    rows = frame(spark, sf, "content")
    return rows.select(
        "content_id",
        sc.blank_to_null(F.col("genre")).alias("genre"),
        sc.blank_to_null(F.col("country")).alias("country"),
        sc.day_number(sc.blank_to_null(F.col("create_time"))).alias("day_number"),
    )


@query
def text_rules(spark, sf):
    rows = frame(spark, sf, "ott_elements")
    return rows.select(
        "movie_id",
        sc.first_code(F.col("drama_type_id")).alias("code"),
        sc.series_flag(F.col("type_id")).alias("series_type"),
        sc.digits_only(F.col("drama_type_id")).alias("digits"),
        sc.csv_row(F.col("movie_id"), F.col("type_id")).alias("line"),
    )


@query
def episode_lookup(spark, sf):
    return episode_map(_part_catalog(spark, sf))


@query
def catalog_children(spark, sf):
    return catalog_members(_part_catalog(spark, sf))


@query
def level_unpivot(spark, sf):
    columns = [(f"level{i}_id", f"level{i}_name") for i in range(1, 5)]
    rows = frame(spark, sf, "relation")
    named = rows.select(
        "content_id", *[c for c, _ in columns], *[sc.default_if_blank(F.col(n)).alias(n) for _, n in columns]
    )
    return level_rows(named, columns, ["content_id"])


@query
def content_metadata(spark, sf):
    relation = frame(spark, sf, "relation").select("content_id", "series_type", "level1_id")
    films = frame(spark, sf, "part_films").select("content_id", F.col("content_name").alias("title"))
    series = _part_catalog(spark, sf).select(
        F.col("catalog_id").alias("content_id"), F.col("name").alias("title")
    )
    return relate_content(relation, films, series)


# Counts, progress, similarity


@query
def user_item_counts(spark, sf):
    return behavior.ott_counts(_event_plays(spark, sf))


@query
def series_rollup_counts(spark, sf):
    return behavior.box_counts_unfiltered(_event_plays(spark, sf), episode_map(_event_catalog(spark, sf)))


@query
def customer_series_counts(spark, sf):
    return behavior.list_counts(frame(spark, sf, "customer_plays"), episode_map(_part_catalog(spark, sf)))


@query
def count_sample(spark, sf):
    return behavior.sample_counts(
        behavior.box_counts(_event_plays(spark, sf), episode_map(_event_catalog(spark, sf)))
    )


@query
def live_plays(spark, sf):
    return behavior.live_plays(_event_plays(spark, sf))


def _completion(spark, sf):
    return reports.series_completion(frame(spark, sf, "customer_plays"), episode_map(_part_catalog(spark, sf)))


@query
def series_completion(spark, sf):
    return _completion(spark, sf).withColumn("ratio", F.round("ratio", 9))


@query
def completion_histogram(spark, sf):
    return reports.completion_histogram(_completion(spark, sf)).withColumn("share", F.round("share", 9))


def _rounded_similarity(ratings):
    measures = ["corr", "reg_corr", "cos_sim", "jaccard"]
    found = reports.item_similarity(ratings)
    return found.select("item1", "item2", *[F.round(m, 6).alias(m) for m in measures])


@query
def itemcf_similarity(spark, sf):
    return _rounded_similarity(frame(spark, sf, "event_ratings"))


@query
def itemcf_ratings_bench(spark, sf):
    return _rounded_similarity(frame(spark, sf, "ratings"))


# Most-viewed lists


def _box_top(spark, sf):
    plays = frame(spark, sf, "part_plays")
    return popularity.box_top(plays, episode_map(_part_catalog(spark, sf)), _part_films(spark, sf))


def _top_columns(lists):
    return lists.select("list_key", "rank", "item_id", "item_name", F.round("views", 9).alias("views"), "payload")


@query
def topn_films(spark, sf):
    return _top_columns(_box_top(spark, sf).where("series_type = 0"))


@query
def topn_series(spark, sf):
    return _top_columns(_box_top(spark, sf).where("series_type = 1"))


@query
def topn_by_level_and_type(spark, sf):
    lists = popularity.level_top(
        frame(spark, sf, "part_plays"),
        episode_map(_part_catalog(spark, sf)),
        frame(spark, sf, "relation"),
    )
    return lists.select("list_key", "rank", "item_id", "series_type", "views", "payload")


@query
def topn_level1_list(spark, sf):
    return popularity.level1_text(
        frame(spark, sf, "part_plays"), episode_map(_part_catalog(spark, sf)), frame(spark, sf, "relation")
    )


@query
def topn_single_product(spark, sf):
    lists = popularity.cinema_top(frame(spark, sf, "part_plays"), _part_films(spark, sf))
    return lists.select("list_key", "rank", "item_id", "views", "payload")


@query
def topn_per_catalog(spark, sf):
    lists = popularity.catalog_top(frame(spark, sf, "part_plays"), frame(spark, sf, "ott_elements"))
    return lists.select("list_key", "rank", "content_id", "views", "payload")


@query
def topn_by_district(spark, sf):
    lists = popularity.district_top(
        frame(spark, sf, "customer_plays"),
        frame(spark, sf, "districts"),
        episode_map(_part_catalog(spark, sf)),
        frame(spark, sf, "relation"),
    )
    return lists.select("list_key", "rank", "item_id", "content_name", F.round("views", 9).alias("views"))


@query
def topn_by_district_whole_views(spark, sf):
    """Ordered by whole views only."""
    lists = popularity.district_top(
        frame(spark, sf, "customer_plays"),
        frame(spark, sf, "districts"),
        episode_map(_part_catalog(spark, sf)),
        frame(spark, sf, "relation"),
        truncate=True,
    )
    return lists.select("list_key", "rank", "item_id")


@query
def dedupe_names_keep_rank_gap(spark, sf):
    parts = table(spark, sf, "part").select("p_brand", "p_partkey", "p_name", "p_retailprice")
    ranked = top_k(parts, ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 30)
    return drop_repeated_names(ranked, ["p_brand"], "p_name").select("p_brand", "rank", "p_partkey", "p_name")


# Contents that share attributes

PAIR_COLUMNS = ["content_id", "level1_id", "rank", "rec_content_id", "rec_title"]


def _attributes(spark, sf):
    return content.attributes(frame(spark, sf, "content"))


def _pair_columns(lists):
    return lists.select(*PAIR_COLUMNS, F.col("rec_day").cast("string").alias("rec_day"))


@query
def content_same_country(spark, sf):
    return _pair_columns(content.films_same_country(_attributes(spark, sf), AS_OF, k=6))


@query
def content_missing_attrs(spark, sf):
    return _pair_columns(content.films_missing_attributes(_attributes(spark, sf), AS_OF, k=6, years=5))


@query
def content_series(spark, sf):
    return _pair_columns(content.series_lists(_attributes(spark, sf), AS_OF, k=6))


@query
def content_education(spark, sf):
    return _pair_columns(content.school_lists(_attributes(spark, sf), AS_OF, k=6, years=5))


@query
def content_random_sample(spark, sf):
    return _pair_columns(content.films_same_country(_attributes(spark, sf), AS_OF, k=6, seed=42))


@query
def series_lists_for_episodes(spark, sf):
    lists = content.series_lists(_attributes(spark, sf), AS_OF, k=6)
    owned = to_episodes(lists.select("content_id", "level1_id", "rank", "rec_content_id"), _series(spark, sf))
    return owned.select("owner_id", "content_id", "level1_id", "rank", "rec_content_id")


@query
def content_box_lists(spark, sf):
    return content.box_lists(frame(spark, sf, "content"), _series(spark, sf), AS_OF)


@query
def content_one_root(spark, sf):
    return content.box_lists(
        frame(spark, sf, "content"), _series(spark, sf), AS_OF, k=20, root="10046284", film_more_than=0
    )


@query
def content_earliest_form(spark, sf):
    return content.box_lists(
        frame(spark, sf, "content"),
        _series(spark, sf),
        AS_OF,
        years=None,
        seed=None,
        keys=content.FILM_KEYS_COARSE,
        school=True,
        film_more_than=0,
        series_more_than=0,
        key_by_type=True,
    )


@query
def content_five_years(spark, sf):
    return content.box_lists(
        frame(spark, sf, "content"), _series(spark, sf), AS_OF, years=5, seed=None, school=True,
        film_more_than=0, series_more_than=0,
    )


@query
def content_union_lists(spark, sf):
    return content.text_lists(frame(spark, sf, "content"), _series(spark, sf), AS_OF)


@query
def content_first_code_pairs(spark, sf):
    lists = content.ott_lists(frame(spark, sf, "ott_elements")).where("type_id <> '21'")
    return lists.select("list_key", "rank", "rec_movie_id", "payload")


@query
def content_school_pairs(spark, sf):
    lists = content.ott_lists(frame(spark, sf, "ott_elements")).where("type_id = '21'")
    return lists.select("list_key", "rank", "rec_movie_id", "payload")


def _part_names(spark, sf):
    return film_names(frame(spark, sf, "part_films"))


@query
def content_catalog_pairs(spark, sf):
    lists = content.cinema_relatives(frame(spark, sf, "cinema_members"), _part_names(spark, sf))
    return lists.select("content_id", "rank", "rec_content_id")


@query
def backfill_to_k(spark, sf):
    lists = content.cinema_lists(frame(spark, sf, "cinema_members"), _part_names(spark, sf))
    return lists.select("content_id", "rank", "rec_content_id", "source")


@query
def web_two_level_pairs(spark, sf):
    lists = content.web_lists(frame(spark, sf, "web_catalog"), frame(spark, sf, "web_elements"))
    return lists.select("list_key", "rank", "rec_movie_id", "payload")


# Newest contents and live television


@query
def newest_per_level(spark, sf):
    return newest.box_newest(frame(spark, sf, "relation")).select("list_key", "rank", "content_id", "payload")


@query
def newest_per_level_and_type(spark, sf):
    lists = newest.box_newest(frame(spark, sf, "relation"), limit_scope="type")
    return lists.select("list_key", "rank", "content_id")


@query
def newest_ott(spark, sf):
    return newest.ott_newest(frame(spark, sf, "ott_elements")).select("list_key", "rank", "movie_id", "payload")


@query
def channel_ranking(spark, sf):
    lists = live.channel_ranking(frame(spark, sf, "channels"), frame(spark, sf, "hourly_audience"), LIVE_DAY)
    return lists.select("rank", "channel_id", "payload")


EXCLUDED = ["ch3", "ch7"]
TYPES = airtime.PROGRAM_TYPES


def _log_lines(spark, sf):
    """Log lines from events: some with a quote, some cut short, some with a field too many."""
    events = table(spark, sf, "events")
    quoted = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('"'), "event_type")).otherwise(F.col("event_type"))
    fields = [F.col("event_id"), quoted, F.lit("x"), F.col("user_id"), F.lit("1"), F.col("event_id") % 97, F.col("user_id"),
              F.lit("prod"), F.lit(""), F.lit("a b"), F.lit('"q"'), F.col("user_id") + 1, F.lit("end")]
    texts = [f.cast("string") for f in fields]
    whole = F.concat_ws(",", *texts)
    return events.select(
        F.when(F.col("event_id") % 7 == 0, F.concat_ws(",", *texts[:6])).otherwise(whole).alias("value")
    )


@query
def log_lines_xor(spark, sf):
    return logs.log_lines(_log_lines(spark, sf), "xor_vod")


@query
def log_lines_vsp(spark, sf):
    return logs.log_lines(_log_lines(spark, sf), "vsp_vod")


@query
def log_lines_ott(spark, sf):
    return logs.log_lines(_log_lines(spark, sf), "ott_play")


@query
def rating_lines(spark, sf):
    lines = table(spark, sf, "events").select(F.concat_ws("::", "user_id", "event_id", "value", F.lit("9")).alias("value"))
    return logs.rating_lines(lines).select("user_id", "item_id", F.round("rating", 6).alias("rating"))


@query
def completion_lines(spark, sf):
    lines = table(spark, sf, "events").select(
        F.concat_ws(",", "user_id", "event_id", F.lit("10"), F.col("event_id") % 10, F.lit("0.5")).alias("value")
    )
    return logs.completion_lines(lines)


@query
def minute_grid(spark, sf):
    """Every minute and category, with how many programmes start in the minute."""
    started = frame(spark, sf, "schedule_rows").select(
        (F.hour("start_time") * 60 + F.minute("start_time")).alias("minute")
    )
    starts = started.groupBy("minute").agg(F.count(F.lit(1)).alias("starts"))
    grid = airtime.minute_grid(spark).join(starts, "minute", "left").withColumn("starts", F.coalesce("starts", F.lit(0)))
    return grid.select("minute", airtime.minute_label(F.col("minute")).alias("label"), "category", "starts")


@query
def live_channels_by_minute(spark, sf):
    lists = airtime.live_lists(
        st.schedule(spark, sf), frame(spark, sf, "audience"), LIVE_DAY, TYPES, EXCLUDED
    )
    return lists.select("minute", "category", "rank", "channel_id")


@query
def filler_choices(spark, sf):
    library = frame(spark, sf, "film_library")
    return airtime.filler_pool(library, airtime.film_library_fillers(), ["media_id"])


@query
def filler_choices_catalogue(spark, sf):
    library = frame(spark, sf, "programme_catalogue")
    return airtime.filler_pool(library, airtime.catalogue_fillers(), ["media_id"])


def _minute_lists(spark, sf, fillers, fields, target, **options):
    lists = live.minute_lists(
        st.schedule(spark, sf), frame(spark, sf, "audience"), fillers, LIVE_DAY, fields, target, excluded=EXCLUDED, **options
    )
    return lists.select("list_key", "n_live", "payload")


@query
def live_minute_lists(spark, sf):
    fields = airtime.FILM_LIBRARY_FIELDS
    fillers = airtime.filler_pool(frame(spark, sf, "film_library"), airtime.film_library_fillers(), list(fields.values()))
    return _minute_lists(spark, sf, fillers, fields, 18)


@query
def live_minute_lists_catalogue(spark, sf):
    fields = airtime.CATALOGUE_FIELDS
    fillers = airtime.filler_pool(frame(spark, sf, "programme_catalogue"), airtime.catalogue_fillers(), list(fields.values()))
    return _minute_lists(spark, sf, fillers, fields, 6, distinct=False)


@query
def channels_on_air_at_events(spark, sf):
    """How many channels, and programmes of how many types, are on air in the second of every event of the day."""
    day = table(spark, sf, "events").where(F.col("ts").cast("date") == F.lit(LIVE_DAY).cast("date"))
    moments = day.select("event_id", airtime.second_of(F.date_trunc("second", "ts"), LIVE_DAY).alias("second"))
    shown = airtime.listable(st.schedule(spark, sf), EXCLUDED)
    found = airtime.on_air(shown, moments, LIVE_DAY, ["program_type"], counted="channel_id")
    return found.groupBy("event_id").agg(
        F.sum("channel_id").alias("channels"), F.countDistinct("program_type").alias("types")
    )


# Trees


@query
def subtree_members(spark, sf):
    starts = frame(spark, sf, "tree_parents").where("parent_id = 9")
    return hierarchy.descendants(frame(spark, sf, "tree_edges"), starts)


@query
def plays_in_subtree(spark, sf):
    members = hierarchy.subtree(_event_catalog(spark, sf), 10046284)
    return behavior.box_counts(_event_plays(spark, sf), episode_map(_event_catalog(spark, sf)), members)


@query
def subtree_customer_plays(spark, sf):
    starts = frame(spark, sf, "tree_parents").where("parent_id = 9")
    members = hierarchy.descendants(frame(spark, sf, "tree_edges"), starts).select(
        (F.col("content_id") - 100000).alias("user_id")
    )
    plays = reports.as_ids(frame(spark, sf, "customer_plays"), "user_id", "content_id")
    return cnt.play_counts(cnt.within(plays, members, "user_id"), "user_id")


@query
def deep_subtree_members(spark, sf):
    """Members below two catalogues of a deep tree with shared children and cycles, by its index."""
    index = treeindex.tree_index(frame(spark, sf, "deep_edges"))
    starts = spark.createDataFrame([(5,), (19,)], "catalog_id bigint")
    return treeindex.members_below(index, starts)


@query
def plays_in_subtree_indexed(spark, sf):
    """Plays below a root, with the members from the catalogue's index."""
    catalog = _event_catalog(spark, sf)
    index = treeindex.tree_index(catalog_members(catalog))
    members = treeindex.members_below(index, catalog.where("parent_id = 10046284").select("catalog_id"))
    return behavior.box_counts(_event_plays(spark, sf), episode_map(catalog), members)


# Kept up to date by days


def _dated_plays(spark, sf):
    return frame(spark, sf, "event_plays").withColumn("dt", F.col("ts").cast("date"))


@query
def rolling_counts(spark, sf):
    """Plays per content of the last ten days: a first load, days one by one, a day that comes late and one that never comes."""
    plays = reports.as_ids(_dated_plays(spark, sf), "content_id").select("dt", "content_id")
    late, never = F.lit("2024-01-27").cast("date"), F.lit("2024-01-25").cast("date")
    rolling = RollingCounts(spark, _new_folder(spark), ["content_id"], spans=[10])
    rolling.load(plays.where((F.col("dt") < "2024-01-26") & (F.col("dt") != never)))
    rolling.load(plays.where((F.col("dt") >= "2024-01-26") & (F.col("dt") < "2024-01-29") & (F.col("dt") != late)), "2024-01-29")
    rolling.load(plays.where((F.col("dt") == late) | (F.col("dt") == "2024-01-29")), "2024-01-30")
    rolling.load(plays.where(F.col("dt") == "2024-01-30"), EVENTS_AS_OF)
    return rolling.counts(10)


@query
def topn_films_rolling(spark, sf):
    """The film list of the free catalogue over the last 30 days, from counts that were kept by days."""
    plays = popularity.known_users(_dated_plays(spark, sf))
    plays = reports.as_ids(plays, "content_id").select("dt", "content_id")
    rolling = RollingCounts(spark, _new_folder(spark), ["content_id"], spans=[30])
    rolling.load(plays.where("dt < DATE '2024-01-20'"))
    rolling.load(plays.where("dt >= DATE '2024-01-20' AND dt < DATE '2024-01-31'"), EVENTS_AS_OF)
    names = film_names(frame(spark, sf, "event_films"))
    return _top_columns(popularity.box_top_of(rolling.counts(30), episode_map(_event_catalog(spark, sf)), names))


@query
def series_completion_bitmaps(spark, sf):
    """Completion of series from bits that were made day by day."""
    episodes = bitmaps.episode_ordinals(episode_map(_event_catalog(spark, sf)))
    plays = reports.as_ids(_dated_plays(spark, sf), "user_id", "content_id")
    days = cut_lineage(bitmaps.seen_bits(plays, episodes, "dt", "user_id"))
    return bitmaps.progress_of(days, episodes, "user_id").withColumn("ratio", F.round("ratio", 9))


@query
def itemcf_in_steps(spark, sf):
    """Similarities from the moments of one half of the days and their changes by the other."""
    rated = frame(spark, sf, "rated_plays")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    stored = cut_lineage(co.unique_ratings(rated.where(early)))
    moments = cut_lineage(co.pair_moments(stored).select("item1", "item2", *deltas.SUMS))
    changes = cut_lineage(deltas.rating_changes(stored, rated.where(~early)))
    ratings = cut_lineage(deltas.merged_ratings(stored, changes))
    merged = deltas.with_raters(deltas.merged_moments(moments, deltas.moment_changes(stored, changes)), ratings)
    measures = ["corr", "reg_corr", "cos_sim", "jaccard"]
    return co.similarities(merged).select("item1", "item2", *[F.round(m, 6).alias(m) for m in measures])


# Factor model


@query
def als_rerank(spark, sf):
    episodes = episode_map(_event_catalog(spark, sf))
    counted = behavior.box_counts(_event_plays(spark, sf, 90), episodes)
    names = film_names(frame(spark, sf, "event_films"))
    return behavior.rerank_lists(counted, 20, "5_10046284_0", names, more_than=10).select(
        "list_key", "rank", "item_id", "score", "payload"
    )


@query
def als_rerank_ott(spark, sf):
    counted = behavior.ott_counts(_event_plays(spark, sf, 90))
    return behavior.rerank_lists(counted, 15, "3_0").select("list_key", "rank", "item_id", "score", "payload")


@query
def als_list(spark, sf):
    counted = behavior.list_counts(_event_plays(spark, sf, 90), episode_map(_event_catalog(spark, sf)))
    return behavior.rerank_text(counted)


@query
def als_customers(spark, sf):
    counted = behavior.list_counts(frame(spark, sf, "customer_plays"), episode_map(_part_catalog(spark, sf)))
    return behavior.rerank_lists(counted, 20, "5_10046284_0").select("list_key", "rank", "item_id", "score", "payload")


@query
def cinema_rerank(spark, sf):
    plays = frame(spark, sf, "customer_plays")
    return behavior.cinema_rerank(plays, frame(spark, sf, "cinema_members")).select(
        "list_key", "rank", "item_id", "source", "payload"
    )


def _list_facts(lists, k):
    """What a list holds whatever the scores are: length, last rank, and all items of a list shorter than k with their payloads.

    ``wrong`` counts payloads whose rank or item is not that of their row, ``rises`` places where the score rises along the list; payloads
    are shown without their rank.
    """
    shown = F.struct("item_id", F.regexp_replace("payload", '"rank":"[0-9]+"', '"rank":""').alias("payload"))
    rank, item = (F.get_json_object("payload", f"$.{name}") for name in ("rank", "movieID"))
    facts = lists.groupBy("list_key").agg(
        F.count(F.lit(1)).alias("listed"),
        F.max("rank").cast("bigint").alias("last_rank"),
        # Lists are short: a distinct aggregate would deal the collected rows by list and item first.
        F.size(F.collect_set("item_id")).cast("bigint").alias("different"),
        F.count_if((rank != F.col("rank").cast("string")) | (item != F.col("item_id").cast("string"))).alias("wrong"),
        F.sort_array(F.collect_list(shown)).alias("rows"),
        F.array_sort(F.collect_list(F.struct("rank", "score", "item_id"))).alias("ranked"),
    )
    ids = F.concat_ws("#", F.transform("rows", lambda x: x["item_id"].cast("string")))
    payloads = F.concat_ws("#", F.transform("rows", lambda x: x["payload"]))
    short = F.col("listed") < k
    # Neighbours in a list of which the later one has the better score, or the same score and the smaller id.
    later = F.slice("ranked", 2, F.size("ranked"))
    rises = F.zip_with(
        F.slice("ranked", 1, F.size("ranked") - 1),
        later,
        lambda a, b: (b["score"] > a["score"]) | ((b["score"] == a["score"]) & (b["item_id"] < a["item_id"])),
    )
    return facts.select(
        "list_key", "listed", "last_rank", "different", "wrong",
        F.size(F.filter(rises, lambda x: x)).cast("bigint").alias("rises"),
        F.when(short, ids).alias("items"), F.when(short, payloads).alias("payloads"),
    )


@query
def als_rerank_facts(spark, sf):
    return _list_facts(als_rerank(spark, sf), 20)


@query
def als_rerank_older_facts(spark, sf):
    """The earlier form: no length rule for ids, no subtree, no gate."""
    episodes = episode_map(_event_catalog(spark, sf))
    counted = behavior.box_counts_unfiltered(_event_plays(spark, sf, 90), episodes)
    return _list_facts(behavior.rerank_lists(counted, 20, "5_10046284_0"), 20)


@query
def als_rerank_ott_facts(spark, sf):
    return _list_facts(als_rerank_ott(spark, sf), 15)


@query
def als_list_facts(spark, sf):
    """Users of the text lists, how many items a list has, and all of them where there are fewer than 15."""
    ids = F.transform(F.split("items", "#"), lambda x: x.cast("bigint"))
    listed = als_list(spark, sf).select("user_id", F.size(ids).cast("bigint").alias("listed"), F.sort_array(ids).alias("ids"))
    whole = F.concat_ws("#", F.transform("ids", lambda x: x.cast("string")))
    return listed.select("user_id", "listed", F.when(F.col("listed") < 15, whole).alias("items"))


@query
def als_fit_facts(spark, sf):
    """What the model was trained on, and what holds of its scores: they are products of factors, finite, and rise with the plays."""
    counted = behavior.list_counts(frame(spark, sf, "customer_plays"), episode_map(_part_catalog(spark, sf)))
    rated = factors.with_int_ids(cut_lineage(counted))
    model = factors.fit(rated)
    scored = factors.factor_products(model, model.transform(rated))
    off = F.abs(F.col("product") - F.col("prediction")) > 1e-4 * (1 + F.abs("prediction"))
    return scored.agg(
        F.count(F.lit(1)).alias("ratings"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("item_id").alias("items"),
        F.sum("plays").alias("plays"),
        F.count_if(off).alias("other_products"),
        F.count_if(F.isnan("prediction") | F.col("prediction").isNull()).alias("no_numbers"),
        (F.corr("prediction", F.col("plays").cast("double")) > 0.2).alias("follows_plays"),
    )


@query
def als_customers_facts(spark, sf):
    return _list_facts(als_customers(spark, sf), 20)


@query
def cinema_rerank_facts(spark, sf):
    """Every user has k ranks, no item twice, and what the user ranked never comes from the catalogue.

    ``unseen`` is whether as many films come from the catalogue as the user has not ranked there, k at most.
    """
    members = frame(spark, sf, "cinema_members")
    counted = behavior.cinema_counts(frame(spark, sf, "customer_plays"))
    ranked = cut_lineage(factors.rerank_played(counted, 20, seed=42))
    lists = cut_lineage(behavior.cinema_lists(ranked, members, 20, 42))
    seen = ranked.select("user_id", "item_id", F.lit(True).alias("seen"))
    told = lists.join(seen, ["user_id", "item_id"], "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("listed"),
        F.max("rank").cast("bigint").alias("last_rank"),
        F.countDistinct("item_id").alias("different"),
        F.count_if((F.col("source") == "catalog") & F.col("seen")).alias("ranked_from_catalog"),
        F.count_if(F.col("source") == "catalog").alias("from_catalog"),
    )
    films = members.select("catalog_id", F.col("content_id").alias("item_id")).distinct()
    # Users are not paired with the films of their catalogue: it has as many free ones as its films less the ranked ones in it.
    own = ranked.select("user_id", "item_id", "rank").join(films, "item_id")
    best = own.where("rank = 1").groupBy("user_id").agg(F.max("catalog_id").alias("catalog_id"))
    met = own.join(best, ["user_id", "catalog_id"]).groupBy("user_id", "catalog_id").agg(F.countDistinct("item_id").alias("met"))
    sizes = films.groupBy("catalog_id").agg(F.count(F.lit(1)).alias("films"))
    free = met.join(sizes, "catalog_id").select("user_id", F.least(F.col("films") - F.col("met"), F.lit(20)).alias("free"))
    checked = told.join(free, "user_id", "left")
    return checked.select(
        F.concat_ws("_", "user_id", F.lit("5"), F.lit(is_.CINEMA_CATALOG), F.lit("0")).alias("list_key"),
        "listed", "last_rank", "different", "ranked_from_catalog", (F.col("from_catalog") == F.coalesce("free", F.lit(0))).alias("unseen"),
    )


@query
def cinema_expand(spark, sf):
    """The expansion alone, on items ranked by plays."""
    counted = behavior.cinema_counts(frame(spark, sf, "customer_plays"))
    ranked = top_k(counted, ["user_id"], [F.desc("plays"), F.asc("item_id")], 20)
    return behavior.cinema_lists(ranked, frame(spark, sf, "cinema_members"))


# Publishing


def _user_items(spark, sf, low, high):
    """Played items of a span of days as lists, newest day excluded."""
    span = _event_plays(spark, sf, high).where(~in_timestamp_window(F.col("ts"), EVENTS_AS_OF, low))
    plays = reports.as_ids(span, "user_id", "content_id")
    counted = cnt.play_counts(plays, "user_id", "content_id")
    ranked = top_k(counted, ["user_id"], [F.desc("plays"), F.asc("content_id")], 15)
    return ranked.select(F.col("user_id").alias("list_key"), "rank", "content_id")


@query
def publish_min_size(spark, sf):
    return longer_than(_user_items(spark, sf, 0, 5), 10)


@query
def publish_not_shrinking(spark, sf):
    return replace_unless_shorter(_user_items(spark, sf, 5, 10), _user_items(spark, sf, 0, 5))


def _new_folder(spark):
    """A folder of this run beside the session's checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"


@query
def publish_lists(spark, sf):
    """Two windows published one after the other: lists of more than three rows, none replaced by a shorter one."""
    store = ListStore(spark, _new_folder(spark), ranges=8)
    store.publish(_user_items(spark, sf, 5, 10), "older", more_than=3)
    store.publish(_user_items(spark, sf, 0, 5), "newer", more_than=3, keep_longer=True)
    return store.read()


@query
def publish_newest_lists(spark, sf):
    """The newest lists of an earlier and of all contents, published by their job; what an outside store holds then."""
    relation = frame(spark, sf, "relation")
    folder = _new_folder(spark)
    store, roots = ListStore(spark, f"{folder}/lists", ranges=8), [f"{folder}/{name}".removeprefix("file:") for name in ("one", "two")]
    publish_job(newest.box_newest(relation.where("resource_time < '2014-01-01'")), store, "early", roots, more_than=9)
    publish_job(newest.box_newest(relation), store, "late", roots, more_than=9, keep_longer=True)
    return read_store(spark, roots[1], "rank int, payload string", roots)


@query
def publish_to_stores(spark, sf):
    """Two windows written to two stores; the second replaces the lists of its keys."""
    folder = _new_folder(spark).removeprefix("file:")
    roots = [f"{folder}/{name}" for name in ("first", "second")]
    publish_to(_user_items(spark, sf, 5, 10), roots, "older")
    publish_to(longer_than(_user_items(spark, sf, 0, 5), 5), roots, "newer")
    kept = [read_store(spark, root, "rank int, content_id bigint", roots).withColumn("store", F.lit(i)) for i, root in enumerate(roots)]
    return kept[0].unionAll(kept[1])


def _bucketed_plays(spark, sf):
    """A log of plays and the users' districts in as many buckets as the log's rows need."""
    folder, name = _new_folder(spark), uuid.uuid4().hex
    plays = reports.as_ids(frame(spark, sf, "customer_plays"), "user_id", "content_id").select("user_id", "content_id")
    buckets = bucketed.buckets_for(table(spark, sf, "lineitem").count())
    log = bucketed.write_bucketed(plays, f"plays_{name}", f"{folder}/plays", ["user_id"], buckets)
    lookup = bucketed.write_bucketed(frame(spark, sf, "districts"), f"districts_{name}", f"{folder}/districts", ["user_id"], buckets)
    return log, lookup


@query
def district_counts_bucketed(spark, sf):
    """Plays per district and content from a log and a lookup that lie in buckets of the user."""
    log, lookup = _bucketed_plays(spark, sf)
    counted = cnt.play_counts(log, "user_id", "content_id").join(lookup, "user_id")
    return counted.groupBy("district", "content_id").agg(F.sum("plays").alias("plays"))


@query
def topn_by_district_bucketed(spark, sf):
    """District lists from a log and a lookup in buckets of the user: counting and placing the plays moves neither."""
    log, lookup = _bucketed_plays(spark, sf)
    counted = cnt.play_counts(log, "user_id", "content_id")
    lists = popularity.district_top_of(counted, lookup, episode_map(_part_catalog(spark, sf)), frame(spark, sf, "relation"))
    return lists.select("list_key", "rank", "item_id", "content_name", F.round("views", 9).alias("views"))


@query
def scan_id_ranges(spark, sf):
    """Orders of some customers from a range scan over ids that crowd at the lower end."""
    folder = _new_folder(spark).removeprefix("file:")
    skewed = F.floor(F.pow(F.col("o_orderkey").cast("double"), 3) / 1000000).cast("bigint")
    orders = table(spark, sf, "orders").select(skewed.alias("id"), "o_orderkey", "o_custkey", "o_totalprice")
    orders.repartition(6).sortWithinPartitions("id").write.option("parquet.block.size", 65536).parquet(folder)
    rows = ranges.range_scan(spark, folder, "id", 12, ["id", "o_orderkey", "o_custkey"], low=10)
    return rows.where("id < 2000000")


@query
def payload_item(spark, sf):
    parts = table(spark, sf, "part")
    return parts.select(
        "p_partkey", item_payload(F.col("p_partkey"), F.col("p_size"), F.col("p_name")).alias("payload")
    )


@query
def payload_top_list(spark, sf):
    parts = table(spark, sf, "part")
    parent = F.when(F.col("p_size") > 9, F.col("p_brand"))
    payload = top_list_payload(F.col("p_partkey"), F.col("p_size"), F.col("p_name"), F.col("p_type"), parent)
    return parts.select("p_partkey", payload.alias("payload"))


@query
def payload_channel(spark, sf):
    rows = frame(spark, sf, "channels")
    payload = channel_payload(F.col("channel_id"), F.col("channel_name"), F.col("channel_image"), F.col("service_id"))
    return rows.select("service_id", payload.alias("payload"))


@query
def pool_fill(spark, sf):
    """Each customer's three largest orders, filled to six ids from all orders of urgent priority."""
    orders = table(spark, sf, "orders")
    own = top_k(
        orders.select("o_custkey", "o_orderkey", "o_totalprice"),
        ["o_custkey"],
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
        3,
    )
    lists = own.groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("ids"))
    pool = orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    filled = fill.fill_lists(lists, fill.pool_of(pool, "o_orderkey"), ["o_custkey"], "ids", 6, 7)
    return filled.select("o_custkey", F.explode("fill").alias("_f")).select("o_custkey", "_f.o_orderkey")
