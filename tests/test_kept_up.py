"""Rolling counts, bitmaps, pair moments by changes, tree index, bucketed tables, range scans, the factor model."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from viewloom.operators import bitmaps, deltas, factors, treeindex
from viewloom.operators import cooccurrence as co
from viewloom.plans.rolling import RollingCounts
from viewloom.session import cut_lineage
from viewloom.sources import bucketed, ranges

START = dt.date(2024, 1, 1)


def test_windows_equal_a_full_read_after_forty_days(spark, tmp_path):
    rng = random.Random(1)
    rows = [(START + dt.timedelta(days=rng.randrange(40)), rng.randrange(6), rng.randrange(4)) for _ in range(4000)]
    plays = spark.createDataFrame(rows, "dt date, content_id long, user_id long").cache()
    rolling = RollingCounts(spark, str(tmp_path), ["content_id", "user_id"], spans=[7, 30])
    late, never = START + dt.timedelta(days=33), START + dt.timedelta(days=21)

    def want(span, until, known):
        return dict(Counter((c, u) for d, c, u in rows if until - dt.timedelta(days=span) <= d < until and d in known))

    def got(span):
        return {(r["content_id"], r["user_id"]): r["plays"] for r in rolling.counts(span).collect()}

    known = {START + dt.timedelta(days=i) for i in range(28)} - {never}
    rolling.load(plays.where(F.col("dt").isin(list(known))))
    for i in range(28, 40):
        day = START + dt.timedelta(days=i)
        new = {day} - {late} | ({late} if i == 36 else set())
        rolling.load(plays.where(F.col("dt").isin(list(new))), day + dt.timedelta(days=1))
        known |= new
        if i in (33, 36, 39):
            for span in (7, 30):
                assert got(span) == want(span, day + dt.timedelta(days=1), known)
    assert rolling.missing(30) == [never.isoformat()] and rolling.missing(7) == []
    # A day that comes again is replaced, and a run that fails changes nothing.
    again = plays.where(F.col("dt") == dt.date(2024, 2, 8)).limit(3)
    rows[:] = [r for r in rows if r[0] != dt.date(2024, 2, 8)] + [tuple(r) for r in again.collect()]
    rolling.load(again)
    assert got(7) == want(7, START + dt.timedelta(days=40), known)
    before = got(30)
    bad = plays.where("dt = DATE '2024-02-09'").withColumn("content_id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        rolling.load(bad, "2024-03-01")
    assert got(30) == before
    rolling.clean(keep=1)
    assert got(30) == before


def test_bits_of_days_count_episodes_once(spark):
    rng = random.Random(2)
    members = [(s * 100 + e, s, 70 if s == 1 else 5) for s in (1, 2) for e in range(70 if s == 1 else 5)]
    episodes = spark.createDataFrame(members, "content_id long, series_id long, n_episodes int")
    ordinals = bitmaps.episode_ordinals(episodes)
    rows = [(rng.randrange(3), rng.choice(members)[0], rng.randrange(5)) for _ in range(300)] + [(9, 1, 0)]
    plays = spark.createDataFrame(rows, "user_id long, content_id long, dt int")
    days = bitmaps.seen_bits(plays, ordinals, "dt", "user_id")
    got = {(r["user_id"], r["series_id"]): (r["watched"], r["total"]) for r in bitmaps.progress_of(days, ordinals, "user_id").collect()}
    series = {c: (s, n) for c, s, n in members}
    want = {}
    for u, c, _ in set((u, c, 0) for u, c, _ in rows if c in series):
        s, n = series[c]
        want[(u, s)] = (want.get((u, s), (0, n))[0] + 1, n)
    assert got == want
    # Bits keep their meaning when a series gets episodes in front of its others.
    more = episodes.union(spark.createDataFrame([(50, 2, 6), (51, 2, 6), (7, 3, 1)], "content_id long, series_id long, n_episodes int"))
    later = {r["content_id"]: r["ordinal"] for r in bitmaps.episode_ordinals(more, ordinals).collect()}
    assert all(later[r["content_id"]] == r["ordinal"] for r in ordinals.collect())
    assert sorted([later[50], later[51]]) == [5, 6] and later[7] == 0


@pytest.mark.parametrize("slices", [1000, 3])
def test_moments_in_steps_equal_one_run(spark, slices):
    rng = random.Random(3)
    rows = [(rng.randrange(8), rng.randrange(12), float(rng.randrange(5))) for _ in range(150)]
    steps = [spark.createDataFrame(part, "user_id long, item_id long, rating double") for part in (rows[:70], rows[70:110], rows[110:])]
    stored = cut_lineage(co.unique_ratings(steps[0]))
    moments = cut_lineage(co.pair_moments(stored).select("item1", "item2", *deltas.SUMS))
    for new in steps[1:]:
        changes = cut_lineage(deltas.rating_changes(stored, new))
        moments = cut_lineage(deltas.merged_moments(moments, deltas.moment_changes(stored, changes, slices)))
        stored = cut_lineage(deltas.merged_ratings(stored, changes))
    whole = co.pair_moments(co.unique_ratings(steps[0].union(steps[1]).union(steps[2])))

    def told(df):
        return {(r["item1"], r["item2"]): tuple(round(r[c], 9) for c in [*deltas.SUMS, "n1", "n2"]) for r in df.collect()}

    assert told(deltas.with_raters(moments, stored)) == told(whole)


def reached(edges, starts):
    below, todo = set(), list(starts)
    while todo:
        node = todo.pop()
        for a, b in edges:
            if a == node and b not in below:
                below.add(b)
                todo.append(b)
    return below


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree_index_equals_a_walk(spark, seed):
    rng = random.Random(seed)
    edges = [(i // 2, i) for i in range(2, 120)]
    edges += [(rng.randrange(1, 120), rng.randrange(1, 120)) for _ in range(6)]  # shared children and cycles
    edges += [(200, 201), (201, 202), (202, 200), (202, 203), (203, 60)]  # a cycle without a way in
    edges += [(5, 5), (2, 4)]
    df = spark.createDataFrame([*edges, (None, 3), (3, None)], "catalog_id long, content_id long")
    index = treeindex.tree_index(df)
    proper = [(a, b) for a, b in edges if a != b]
    for starts in ([1], [7, 30], [203], [201], [999], []):
        asked = spark.createDataFrame([(s,) for s in starts], "catalog_id long")
        got = {r["content_id"] for r in treeindex.members_below(index, asked).collect()}
        assert got == reached(proper, starts), starts


def test_places_are_a_walk_and_reach_the_scan(spark, tmp_path):
    edges = spark.createDataFrame([(i // 3, i) for i in range(1, 800)], "catalog_id long, content_id long")
    index = treeindex.tree_index(edges)
    rows = {r["id"]: r for r in index.nodes.collect()}
    assert sorted(r["place"] for r in rows.values()) == list(range(800)) and max(r["depth"] for r in rows.values()) == 8
    assert all(rows[i // 3]["place"] < rows[i]["place"] <= rows[i]["last"] <= rows[i // 3]["last"] for i in range(1, 800))
    assert index.links.count() == 0
    inside = treeindex.inside(index.nodes, index, 4)
    assert {r["id"] for r in inside.collect()} == {4} | reached([(i // 3, i) for i in range(1, 800)], [4])
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(place" in plan and "LessThanOrEqual(place" in plan
    assert treeindex.inside(index.nodes, index, 10**6).count() == 0
    assert treeindex.tree_index(edges.limit(0)).nodes.count() == 0


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    names = ["kept_up_plays", "kept_up_places"]
    plays = spark.range(3000).select((F.col("id") % 97).alias("user_id"), F.col("id").alias("content_id"))
    places = spark.range(97).select(F.col("id").alias("user_id"), (F.col("id") % 5).alias("district"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = bucketed.write_bucketed(plays, names[0], str(tmp_path / "a"), ["user_id"], 4)
        right = bucketed.write_bucketed(places, names[1], str(tmp_path / "b"), ["user_id"], 4)
        counted = left.groupBy("user_id").count().join(right, "user_id")
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert counted.agg(F.sum("count")).first()[0] == 3000
        assert counted.groupBy("district").count().count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in names:
            bucketed.drop_bucketed(spark, name)


def test_ranges_hold_equally_many_rows():
    rng = random.Random(4)
    ids = sorted(min(int(rng.paretovariate(0.3)), 10**15 + rng.randrange(10**6)) for _ in range(20_000))
    groups = [(ids[i], ids[min(i + 499, len(ids) - 1)], 500) for i in range(0, len(ids), 500)]
    found = ranges.equal_ranges(groups, 10)
    assert found[0][0] == ranges.LOWEST and found[-1][1] == ranges.HIGHEST
    assert all(a[1] + 1 == b[0] for a, b in zip(found[:-1], found[1:], strict=True))
    sizes = [sum(a <= i <= b for i in ids) for a, b in found]
    hot = max(Counter(ids).values())
    assert sum(sizes) == 20_000 and max(sizes) <= 2000 + 2 * 500 + hot
    assert ranges.equal_ranges([], 4, 5, 9) == [(5, 9)] and ranges.equal_ranges(groups, 1) == [(ranges.LOWEST, ranges.HIGHEST)]


def test_range_scan_reads_all_rows_or_those_asked_for(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.range(5000).select(F.pow(F.col("id"), 2).cast("long").alias("id"), F.col("id").cast("string").alias("name"), F.lit(1.5).alias("v"))
    df = df.union(spark.createDataFrame([(None, "none", 0.0), (0, "again", 0.0)], df.schema))
    df.repartitionByRange(5, "id").write.parquet(path)
    whole = ranges.range_scan(spark, path, "id", 7)
    assert whole.rdd.getNumPartitions() > 4
    assert sorted(map(str, whole.collect())) == sorted(map(str, df.collect()))
    some = ranges.range_scan(spark, path, "id", 7, ["name", "id"], low=100, high=10_000)
    assert some.columns == ["name", "id"]
    assert sorted(r["id"] for r in some.collect()) == [i * i for i in range(10, 101)]
    assert ranges.range_scan(spark, path, "id", low=9, high=3).count() == 0
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = ranges.range_scan(spark, path, "id", 5).where("id > 81 AND id <= 400 AND name <> '12'")
        assert sorted(r["id"] for r in pushed.collect()) == [i * i for i in range(10, 21) if i != 12]
        assert ranges.range_scan(spark, path, "id", 5).where("id = 49").count() == 1
        assert ranges.range_scan(spark, path, "id", 5).count() == 5002
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_scores_are_products_of_the_factors(spark):
    rng = random.Random(5)
    rows = [(u, i, rng.randrange(1, 9)) for u in range(12) for i in rng.sample(range(9), 5)]
    counts = spark.createDataFrame(rows, "user_id long, item_id long, plays long")
    rated = factors.with_int_ids(counts)
    model = factors.fit(rated, rank=4, iterations=3)
    users = {r["id"]: r["features"] for r in model.userFactors.collect()}
    items = {r["id"]: r["features"] for r in model.itemFactors.collect()}
    number = {(r["user_id"], r["item_id"]): (r["_user"], r["_item"]) for r in rated.collect()}
    ranked = factors.rerank_played(counts, 3, rank=4, iterations=3).collect()
    want = {}
    for (u, i), (x, y) in number.items():
        want.setdefault(u, []).append((-sum(a * b for a, b in zip(users[x], items[y], strict=True)), i))
    assert len(ranked) == 36
    for r in ranked:
        score, item = sorted(want[r["user_id"]])[r["rank"] - 1]
        assert r["item_id"] == item and abs(r["score"] + score) < 1e-4


def test_too_large_blocks_are_an_error(spark):
    rated = factors.with_int_ids(spark.createDataFrame([(u, u % 3, 1) for u in range(30)], "user_id long, item_id long, plays long"))
    factors.check_blocks(rated, 5, 10)
    with pytest.raises(ValueError, match="one item"):
        factors.check_blocks(rated, 5, 9)
    with pytest.raises(ValueError, match="3 blocks"):
        factors.check_blocks(rated, 2, 10)
