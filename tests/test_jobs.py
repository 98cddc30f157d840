"""Jobs on small hand-made inputs."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import math

import pytest
from pyspark.sql import functions as F

from viewloom.operators import airtime, cooccurrence, counts, factors
from viewloom.plans import behavior, content, live, newest, popularity, reports
from viewloom.sinks import lists as sink
from viewloom.sources.metadata import episode_map

CATALOG = "catalog_id bigint, parent_id bigint, name string, type int, sort_index string"
PLAYS = "user_id string, content_id string, product_key string, play_type string, flag4 string, watch_seconds string"
FREE = "ahyuvzq53adjct"


def episodes(spark):
    return episode_map(spark.createDataFrame([(100, 1, "S", 1, "1;2"), (101, 1, "T", 1, "2;3")], CATALOG))


def plays(spark, *rows):
    return spark.createDataFrame([(u, c, key, "1", "1", "61") for u, c, key in rows], PLAYS)


def test_counts_roll_up_once(spark):
    df = plays(spark, ("7", "1", FREE), ("7", "1", FREE), ("7", "2", FREE), ("7", "9", FREE), ("7", "9", "other"), ("x", "9", FREE), ("12345678901", "9", FREE))
    got = {(r["item_id"], r["plays"]) for r in behavior.box_counts(df, episodes(spark)).collect()}
    assert got == {(100, 2), (101, 1), (9, 1)}
    assert behavior.box_counts_unfiltered(df, episodes(spark)).count() == 4
    members = spark.createDataFrame([(1,)], "content_id bigint")
    assert [tuple(r) for r in behavior.box_counts(df, episodes(spark), members).collect()] == [(7, 100, 2)]


def test_views_are_divided_by_episodes(spark):
    counted = spark.createDataFrame([(1, 3), (2, 4), (9, 5)], "content_id bigint, plays bigint")
    films = spark.createDataFrame([(9, "film")], "content_id bigint, content_name string")
    got = {r["item_id"]: (r["series_type"], r["views"], r["item_name"]) for r in counts.views_by_item(counted, episodes(spark), films=films).collect()}
    assert got == {100: (1, 1.5, "S"), 101: (1, 2.0, "T"), 9: (0, 5.0, "film")}
    plain = {r["item_id"]: r["views"] for r in counts.views_by_item(counted, episodes(spark), normalise=False).collect()}
    assert plain == {100: 3.0, 101: 4.0, 9: 5.0}


def brute_similarity(rows):
    by_user, raters = {}, {}
    for u, i, r in rows:
        by_user.setdefault(u, {})[i] = r
    for basket in by_user.values():
        for i in basket:
            raters[i] = raters.get(i, 0) + 1
    pairs = {}
    for basket in by_user.values():
        for i, j in itertools.combinations(sorted(basket), 2):
            pairs.setdefault((i, j), []).append((basket[i], basket[j]))
    out = {}
    for (i, j), v in pairs.items():
        n, xy = len(v), sum(a * b for a, b in v)
        x, y, xx, yy = sum(a for a, _ in v), sum(b for _, b in v), sum(a * a for a, _ in v), sum(b * b for _, b in v)
        den = math.sqrt(n * xx - x * x) * math.sqrt(n * yy - y * y)
        corr = None if den == 0 else (n * xy - x * y) / den
        out[(i, j)] = (corr, None if corr is None else n / (n + 10) * corr, xy / math.sqrt(xx) / math.sqrt(yy), n / (raters[i] + raters[j] - n))
    return out


@pytest.mark.parametrize("slice_items", [2, 1000])
def test_similarity_with_heavy_users(spark, slice_items):
    rows = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(8) for i in range(25) if u == 0 or (u + i) % 4 == 0]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    got = cooccurrence.similarities(cooccurrence.pair_moments(cooccurrence.unique_ratings(df), slice_items))
    got = {(r["item1"], r["item2"]): tuple(r)[2:] for r in got.collect()}
    want = brute_similarity(rows)
    assert got.keys() == want.keys()
    for pair, values in want.items():
        assert got[pair] == pytest.approx(values, nan_ok=True)


def test_dense_index(spark):
    ids = spark.createDataFrame([(i * 10**12,) for i in range(500)] * 2, "id bigint")
    index = factors.dense_index(ids, "id", "n", buckets=16).collect()
    assert sorted(r["n"] for r in index) == list(range(500))
    assert len({r["id"] for r in index}) == 500


@pytest.mark.parametrize("offset", [0, 10**12])
def test_reranking_scores_played_items_only(spark, offset):
    rows = [(offset + u, offset + i, 1 + (u + i) % 4) for u in range(12) for i in range(10) if (u * i) % 3]
    counted = spark.createDataFrame(rows, "user_id bigint, item_id bigint, plays bigint")
    ranked = factors.rerank_played(counted, 5, rank=4, iterations=3).collect()
    played = {(u, i) for u, i, _ in rows}
    assert {(r["user_id"], r["item_id"]) for r in ranked} <= played
    for user in {u for u, _ in played}:
        mine = sorted((r["rank"], -r["score"]) for r in ranked if r["user_id"] == user)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)
        assert len(mine) == min(5, sum(1 for u, _ in played if u == user))


def test_user_lists(spark):
    ranked = spark.createDataFrame([(7, 1, 0.5, 1)], "user_id bigint, item_id bigint, score double, rank int")
    row = behavior.user_lists(ranked, "5_10046284_0").first()
    assert row["list_key"] == "7_5_10046284_0"
    assert json.loads(row["payload"])["assetname"] == " "


CONTENT = "content_id bigint, title string, genre string, create_time string, country string, series_type string, level1_id string, level2_id string, level3_id string, level4_id string"


def test_content_branches(spark):
    rows = [
        (1, "a", "g", "2015-05-01 00:00:00", "C", "0", "102", None, "0", "0"),
        (2, "b", "g", "2015-06-01", "C", "0", "102", None, "0", "0"),
        (3, "a", "g", "2015-07-01", "C", "0", "102", None, "0", "0"),  # same title as 1
        (4, "d", "g", "2010-01-01", "C", "0", "102", None, "0", "0"),  # too old to be recommended
        (5, "e", "g", "2015-07-01", "D", "0", "102", None, "0", "0"),  # other country
        (6, "f", "g", "2015-08-01", "", "0", "102", None, "0", "0"),  # no country
        (7, "h", "g", "无", "C", "0", "102", None, "0", "0"),  # no date
        (8, "i", "null", "2015-08-01", "C", "0", "102", None, "0", "0"),  # no genre
        (9, "j", "g", "2015-08-01", "C", "0", "10001059", "1", "0", "0"),  # school
        (10, "k", "h", "2015-08-01", "C", None, None, None, "0", "0"),  # no type, no level
        (11, "l", "h", "2015-08-02", "C", None, None, None, "0", "0"),
    ]
    attrs = content.attributes(spark.createDataFrame(rows, CONTENT))
    got = {}
    for r in content.related(attrs, "2016-01-01").collect():
        got.setdefault(r["content_id"], []).append((r["rank"], r["rec_content_id"]))
    assert {k: [i for _, i in sorted(v)] for k, v in got.items()} == {1: [2], 2: [3], 3: [2], 4: [3, 2], 7: [6], 10: [11], 11: [10]}


def test_series_lists_reach_episodes(spark):
    rows = [(i, f"s{i}", "g", "2015-05-01", "C", "1", "102", None, "0", "0") for i in range(100, 108)]
    series = spark.createDataFrame([(100, "1;2"), (101, None), (102, "2;")], "content_id bigint, sort_index string")
    lists = content.box_lists(spark.createDataFrame(rows, CONTENT), series, "2016-01-01")
    owners = {}
    for r in lists.collect():
        owners.setdefault(r["list_key"], []).append(r["rec_content_id"])
    assert set(owners) == {"100_5_102_0", "1_5_102_0", "2_5_102_0", "102_5_102_0"}
    assert 102 not in owners["2_5_102_0"]  # episode of two series: the larger one's list
    assert all(len(v) == 7 for v in owners.values())


def test_cinema_lists_keep_untitled_films(spark):
    members = spark.createDataFrame([(1, i) for i in range(5)], "catalog_id bigint, content_id bigint")
    names = spark.createDataFrame([(0, "x"), (1, "x")], "content_id bigint, content_name string")
    lists = content.cinema_lists(members, names, k=4)
    own = {}
    for r in lists.where("source = 'catalog'").collect():
        own.setdefault(r["content_id"], set()).add(r["rec_content_id"])
    assert own == {0: {2, 3, 4}, 1: {2, 3, 4}, 2: {0, 1, 3, 4}, 3: {0, 1, 2, 4}, 4: {0, 1, 2, 3}}
    filled = lists.groupBy("content_id").count().collect()
    assert all(r["count"] == 4 for r in filled)


def test_newest_limits_before_the_split(spark):
    rows = [(i, f"n{i}", "1" if i == 0 else "0", f"2015-01-{10 + i}", "77", "0", "0", "0", "0", "") for i in range(5)]
    df = spark.createDataFrame(rows + rows, "content_id bigint, content_name string, series_type string, resource_time string, level1_id string, level2_id string, level3_id string, level4_id string, level5_id string, level6_id string")
    got = {}
    for r in newest.box_newest(df, 3).collect():
        got.setdefault(r["list_key"], []).append((r["rank"], r["content_id"]))
    assert {k: sorted(v) for k, v in got.items()} == {"Newcontentlist_5_0_0": [(1, 4), (2, 3), (3, 2)], "Newcontentlist_5_77_0": [(1, 4), (2, 3), (3, 2)]}
    typed = {r["list_key"] for r in newest.box_newest(df, 3, "type").collect()}
    assert "Newcontentlist_5_0_1" in typed
    with pytest.raises(ValueError):
        newest.box_newest(df, 3, "none")


def day(hour, minute, second=0, days=0):
    return dt.datetime(2024, 1, 15, hour, minute, second) + dt.timedelta(days=days)


SCHEDULE = "channel_id string, service_id bigint, start_time timestamp_ntz, end_time timestamp_ntz, program_type string, wiki_title string"


def test_minutes_are_half_open(spark):
    rows = [
        ("a", 1, day(10, 0), day(10, 2), "电影", "w"),
        ("b", 2, day(10, 0, 30), day(10, 1, 30), "电影", "w"),
        ("c", 3, day(23, 58, days=-1), day(0, 1), "其他", "w"),
        ("d", 4, day(23, 59), day(2, 0, days=1), "x", "w"),
        ("e", 5, day(11, 0, 10), day(11, 0, 50), "x", "w"),
        ("f", 6, day(12, 0), day(11, 0), "x", "w"),
    ]
    minutes = airtime.on_air_minutes(spark.createDataFrame(rows, SCHEDULE), "2024-01-15", ["channel_id"])
    got = {(r["channel_id"], r["minute"]) for r in minutes.collect()}
    assert got == {("a", 600), ("a", 601), ("b", 601), ("c", 0), ("d", 1439)}


def test_live_lists_and_filler(spark):
    rows = [
        ("a", 1, day(10, 0), day(10, 1), "电影", "w"),
        ("a", 1, day(9, 0), day(11, 0), "电影", "w"),  # the same channel twice at 10:00
        ("b", 2, day(10, 0), day(10, 1), "电影", "w"),
        ("cctv1", 3, day(10, 0), day(10, 1), "电影", "w"),
        ("d", 4, day(10, 0), day(10, 1), "电影", "广告"),
        ("e", 5, day(10, 0), day(10, 1), "其他", "w"),
    ]
    audience = spark.createDataFrame(
        [(2, 5.0, dt.date(2024, 1, 8), "1000"), (2, 1.0, dt.date(2024, 1, 8), "1000"), (1, 9.0, dt.date(2024, 1, 9), "1000")],
        "channel bigint, tv_rating double, date_time date, minute_time string",
    )
    schedule = spark.createDataFrame(rows, SCHEDULE)
    lists = airtime.live_lists(schedule, audience, "2024-01-15").where("minute = 600").collect()
    got = {}
    for r in sorted(lists, key=lambda r: r["rank"]):
        got.setdefault(r["category"], []).append(r["channel_id"])
    assert got == {"all": ["b", "a", "e"], "电影": ["b", "a"]}
    fillers = spark.createDataFrame(
        [("all", i, f"n{i}", i % 7, None) for i in range(40)] + [("电影", i, None, 1, "p") for i in range(3)],
        "category string, media_id bigint, name string, ind int, image string",
    )
    objects = live.minute_lists(schedule, audience, fillers, "2024-01-15", target=4).collect()
    assert len(objects) == 1440 * 9
    found = {r["list_key"]: json.loads(r["payload"]) for r in objects}
    assert len(found["1000_all"]["rec_vodlist"]) == 1 and len(found["0000_all"]["rec_vodlist"]) == 4
    assert found["1000_电影"]["rec_livelist"] == ["b", "a"] and len(found["1000_电影"]["rec_vodlist"]) == 2
    assert found["0000_体育"] == {"rec_livelist": [], "rec_vodlist": []}
    shown = found["1000_all"]["rec_vodlist"][0]
    assert list(shown) == ["name_cn", "mediaid", "index", "p_pic"]
    assert shown == {"name_cn": f"n{shown['mediaid']}", "mediaid": shown["mediaid"], "index": str(int(shown["mediaid"]) % 7), "p_pic": ""}


def test_district_and_catalog_lists(spark):
    df = plays(spark, ("1", "9", FREE), ("1", "9", FREE), ("2", "9", FREE), ("2", "8", FREE))
    districts = spark.createDataFrame([(1, "d1"), (2, "d2"), (2, "d2")], "user_id bigint, district string")
    levels = spark.createDataFrame([(9, "nine", "77"), (8, "eight", "77")], "content_id bigint, content_name string, level1_id string")
    rows = popularity.district_top(df, districts, episodes(spark), levels).collect()
    assert sorted((r["list_key"], r["rank"], r["item_id"], r["views"]) for r in rows) == [
        ("d1_5_0_77", 1, 9, 2.0), ("d2_5_0_77", 1, 8, 1.0), ("d2_5_0_77", 2, 9, 1.0)
    ]
    elements = spark.createDataFrame([(9, "nine", 5), (8, "eight", 5)], "movie_id bigint, movie_name string, catalog_id int")
    rows = popularity.catalog_top(df, elements).collect()
    assert sorted((r["rank"], r["content_id"], json.loads(r["payload"])["rank"], json.loads(r["payload"])["providerId"]) for r in rows) == [
        (1, 9, "3", "1"), (2, 8, "1", "2")
    ]


LISTS = "list_key string, rank int, v string"


def test_gates(spark):
    new = spark.createDataFrame([("a", 1, "n"), ("a", 2, "n"), ("b", 1, "n")], LISTS)
    old = spark.createDataFrame([("a", 1, "o"), ("b", 1, "o"), ("b", 2, "o"), ("c", 1, "o")], LISTS)
    kept = sink.replace_unless_shorter(old, new).collect()
    assert sorted(tuple(r) for r in kept) == [("a", 1, "n"), ("a", 2, "n"), ("b", 1, "o"), ("b", 2, "o"), ("c", 1, "o")]
    assert {r["list_key"] for r in sink.longer_than(new, 1).collect()} == {"a"}


def test_runs_replace_their_own_date(spark, tmp_path):
    path = str(tmp_path / "lists")
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], LISTS)
    second = spark.createDataFrame([("b", 1, "z")], LISTS)
    sink.write_lists(first, path, "2024-01-01")
    sink.write_lists(first, path, "2024-01-02")
    sink.write_lists(second, path, "2024-01-02")
    assert sink.read_lists(spark, path, "2024-01-01").count() == 2
    assert [tuple(r) for r in sink.read_lists(spark, path, "2024-01-02").collect()] == [("b", 1, "z")]


def test_text_and_replicas(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3, 4, 0.5)], "user_id bigint, series_id bigint, total bigint, watched bigint, ratio double")
    paths = [str(tmp_path / "one"), str(tmp_path / "two")]
    for _ in range(2):
        sink.replicate(df, [lambda d, p=p: sink.write_text(d, p) for p in paths])
    from viewloom.sources.logs import read_completion

    for p in paths:
        read = read_completion(spark, p)
        assert [tuple(r) for r in read.collect()] == [(1, 2, 3, 4, 0.5)]
        assert reports.completion_histogram(read).first()["bin"] == 0.5


def test_writer_sees_whole_lists_in_order(spark, tmp_path):
    rows = [(f"k{i % 7}", 1 + i // 7, str(i)) for i in range(70)]
    out = str(tmp_path)

    def write(part):
        import os
        import uuid

        lines = [f"{r['list_key']},{r['rank']}" for r in part]
        with open(os.path.join(out, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(lines))

    sink.each_partition(spark.createDataFrame(rows, LISTS), write)
    seen = {}
    for name, path in enumerate(tmp_path.iterdir()):
        for line in path.read_text().split():
            key, rank = line.split(",")
            seen.setdefault((key, name), []).append(int(rank))
    assert len(seen) == 7 and all(v == list(range(1, 11)) for v in seen.values())
