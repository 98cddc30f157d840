"""Ranked lists, shortlists and fills against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from viewloom.operators import fill, ranking
from viewloom.operators.positions import drawn_positions, numbered
from viewloom.operators.shortlist import newest_first, recommend_by_draw, recommend_by_order
from viewloom.operators.spans import join_points, segments


def md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def test_top_k_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 1, 1.0), ("a", 2, 2.0), ("b", 9, 0.5)], "g string, id int, v double")
    rows = ranking.top_k(df, ["g"], [F.desc("v"), F.asc("id")], 2).collect()
    assert sorted((r["g"], r["rank"], r["id"]) for r in rows) == [("a", 1, 2), ("a", 2, 1), ("b", 1, 9)]
    rows = ranking.top_k(df, [], [F.desc("v"), F.asc("id")], 2).collect()
    assert sorted((r["rank"], r["id"]) for r in rows) == [(1, 2), (2, 1)]


def test_top_k_limits_groups_before_the_shuffle(spark):
    plan = ranking.top_k(spark.range(100).withColumn("g", F.col("id") % 3), ["g"], [F.asc("id")], 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange hashpartitioning(g") < text.index("Partial")


def test_long_lists_are_salted_exactly(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"), "id")
    want = df.where("g = 0").orderBy("v").limit(1200).collect()
    rows = ranking.top_k(df, ["g"], [F.asc("v")], 1200).where("g = 0").orderBy("rank").collect()
    assert [(r["rank"], r["id"]) for r in rows] == [(i + 1, r["id"]) for i, r in enumerate(want)]


def test_only_groups_with_more(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(3)], "g string, id int")
    rows = ranking.top_k_if_more(df, ["g"], [F.asc("id")], 2, 3).collect()
    assert sorted((r["g"], r["rank"]) for r in rows) == [("a", 1), ("a", 2)]


def test_repeated_names_leave_gaps(spark):
    df = spark.createDataFrame([("l", 1, "x"), ("l", 2, "x"), ("l", 3, "y")], "l string, rank int, n string")
    rows = ranking.drop_repeated_names(df, ["l"], "n").collect()
    assert sorted((r["rank"], r["n"]) for r in rows) == [(1, "x"), (3, "y")]


def test_optional_grain_and_guard(spark):
    df = spark.createDataFrame([(1, 0)], "id int, t int")
    assert sorted(str(r["t"]) for r in ranking.with_optional_grain(df, "t").collect()) == ["0", "None"]
    assert ranking.at_least(spark.range(3), 2).count() == 3
    assert ranking.at_least(spark.range(3), 3).count() == 0


def items(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = rng.choice(["hot", "hot", "hot", "g1", "g2", None])
        title = rng.choice(["same", "same", "t1", "t2", None, f"u{i}", f"u{i}"])
        day = rng.choice([None, "2015-01-01", "2015-02-01", "2015-03-01", f"2015-04-{1 + i % 28:02d}"])
        rows.append((i, group, title, day))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "content_id long, g string, title string, day string")
    return df.withColumn("day", F.col("day").cast("date"))


def eligible(rows, target):
    i, group, title, _ = target
    return [r for r in rows if r[1] == group and r[0] != i and (title is None or r[2] is None or r[2] != title)]


def first_titles(picked):
    seen, out = set(), []
    for r in picked:
        if r[2] is None or r[2] not in seen:
            out.append(r[0])
        seen.add(r[2])
    return out


def by_day(row):
    return (-int(row[3].replace("-", "")) if row[3] else 0, row[0])


def collected(lists):
    out = {}
    for r in lists.collect():
        out.setdefault(r["content_id"], []).append((r["rank"], r["rec_content_id"], r["rec_count"]))
    for target, entries in out.items():
        entries.sort()
        assert [e[0] for e in entries] == list(range(1, len(entries) + 1))
        assert {e[2] for e in entries} == {len(entries)}
        out[target] = [e[1] for e in entries]
    return out


@pytest.mark.parametrize("seed,k", [(1, 4), (2, 15), (3, 1)])
def test_ordered_lists_equal_all_pairs(spark, seed, k):
    rows = items(seed)
    df = frame(spark, rows)
    order = [newest_first(F.col("day")), F.col("content_id")]
    got = collected(recommend_by_order(df, df, ["g"], order, k))
    want = {t[0]: first_titles(sorted(eligible(rows, t), key=by_day)[:k]) for t in rows}
    assert got == {t: ids for t, ids in want.items() if ids}


def number(*parts):
    return int(md5(*parts)[:15], 16)


def drawn(n, m, *seed):
    """The draw by its rule: a number up to j, or j itself."""
    taken, m = [], min(m, n)
    for i in range(m):
        j = n - m + i
        x = number(*seed, i) % (j + 1)
        taken.append(j if x in taken else x)
    return taken


@pytest.mark.parametrize("n,m", [(0, 3), (1, 1), (5, 5), (5, 9), (40, 7), (10**12, 4), (7, 0)])
def test_positions_follow_the_rule(spark, n, m):
    rows = spark.range(30).select("id", drawn_positions(F.lit(n), F.lit(m), 3, F.col("id")).alias("at")).collect()
    assert all(r["at"] == drawn(n, m, 3, r["id"]) for r in rows)
    assert all(len(set(r["at"])) == min(m, n) for r in rows)


def test_rows_are_numbered_in_order_across_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("g"), F.xxhash64("id").alias("v")).repartition(7)
    rows = numbered(df.unionAll(df.limit(5)), ["g", "v"]).collect()
    assert [(r["g"], r["v"]) for r in sorted(rows, key=lambda r: r["_at"])] == sorted((r["g"], r["v"]) for r in rows)
    assert sorted(r["_at"] for r in rows) == list(range(5005))
    assert numbered(df.limit(0), ["g"]).count() == 0


@pytest.mark.parametrize("seed,k", [(4, 4), (5, 15)])
def test_drawn_lists_equal_the_rule(spark, seed, k):
    rows = items(seed)
    rows.append((3, rows[3][1], "a second title of the same id", None))
    df = frame(spark, rows)
    order = [newest_first(F.col("day")), F.col("content_id")]
    targets = df.where("NOT title <=> 'a second title of the same id'")
    got = collected(recommend_by_draw(targets, df, ["g"], order, k, 9))

    def titled(r):
        return f"#{r[0]}" if r[2] is None else f"={r[2]}"

    want = {}
    for t in rows[:-1]:
        group = sorted((r for r in rows if r[1] == t[1]), key=lambda r: (hashlib.md5(titled(r).encode()).hexdigest(), titled(r), r[0]))
        others = [r for r in group if titled(r) != titled(t)]
        twins = sum(r[0] == t[0] for r in others)
        pool = [others[i] for i in drawn(len(others), k + twins, 9, t[0]) if others[i][0] != t[0]]
        whole = len(others) - twins >= k
        pool.sort(key=lambda r: md5(9, t[0], r[0]) if whole else by_day(r))
        want[t[0]] = first_titles(pool[:k])
    assert got == {t: ids for t, ids in want.items() if ids}


def lists_of(spark, n, k, seed):
    df = spark.range(n).select(F.col("id").alias("content_id"), F.lit("g").alias("g"), F.lit(None).cast("string").alias("title"))
    return recommend_by_draw(df, df, ["g"], [F.col("content_id")], k, seed)


def test_draws_differ_within_a_group(spark):
    got = collected(lists_of(spark, 400, 5, 1))
    assert all(len(set(ids)) == 5 and t not in ids for t, ids in got.items())
    assert len({tuple(ids) for ids in got.values()}) > 390


def test_no_pair_of_a_large_group_is_favoured(spark):
    """Chi-squared of targets and items, by classes of a hundredth each, and of pairs within a list, by distance."""
    n, k, classes = 20_000, 15, 100
    rows = lists_of(spark, n, k, 1).select("content_id", "rec_content_id", "rank")
    pairs = rows.groupBy((F.col("content_id") % classes).alias("t"), (F.col("rec_content_id") % classes).alias("i")).count().collect()
    assert sum(r["count"] for r in pairs) == n * k and len(pairs) == classes * classes
    # A target never draws itself, so its own class offers one item less.
    expected = {True: n * k / classes * (n // classes - 1) / (n - 1) , False: n * k / classes * (n // classes) / (n - 1)}
    statistic = sum((r["count"] - expected[r["t"] == r["i"]]) ** 2 / expected[r["t"] == r["i"]] for r in pairs)
    degrees = classes * classes - 1
    assert abs(statistic - degrees) < 5 * math.sqrt(2 * degrees)
    used = rows.groupBy("rec_content_id").count().agg(F.count(F.lit(1)), F.min("count"), F.max("count")).first()
    assert used[0] == n and used[1] > 0 and used[2] < 50
    first, second = rows.where("rank = 1"), rows.where("rank = 2").select("content_id", F.col("rec_content_id").alias("next"))
    apart = first.join(second, "content_id").groupBy(F.floor(F.pmod(F.col("next") - F.col("rec_content_id"), F.lit(n)) / 200).alias("d")).count()
    counts = [r["count"] for r in apart.collect()]
    assert len(counts) == 100 and abs(sum((c - 200) ** 2 / 200 for c in counts) - 99) < 5 * math.sqrt(198)


def test_fills_use_most_of_a_large_pool(spark):
    lists = spark.range(20_000).select(F.col("id").alias("t"), F.array().cast("array<bigint>").alias("ids"))
    pool = fill.pool_of(spark.range(50_000).toDF("p"), "p")
    used = fill.fill_lists(lists, pool, ["t"], "ids", 20, 5).select(F.explode("fill.p").alias("p"))
    assert used.count() == 400_000 and used.distinct().count() > 49_000


@pytest.mark.parametrize("pool_size", [0, 3, 10, 300])
def test_fill_equals_the_rule(spark, pool_size):
    k, rng = 6, random.Random(pool_size)
    lists = [(t, sorted(rng.sample(range(400), rng.randint(0, k)))) for t in range(40)]
    df = spark.createDataFrame(lists, "t long, ids array<long>")
    frame_ = spark.createDataFrame([(p,) for p in range(pool_size)] * 2, "p long") if pool_size else spark.range(0).toDF("p")
    done = fill.fill_lists(df, fill.pool_of(frame_, "p"), ["t"], "ids", k, 5, exclude=["t"])
    got = {r["t"]: [x["p"] for x in r["fill"]] for r in done.collect()}
    for t, ids in lists:
        lacking = k - len(ids)
        free = [p for p in drawn(pool_size, lacking + len(ids) + 1, 5, t) if p not in ids and p != t] if lacking else []
        free.sort(key=lambda p: md5(5, t, p))
        assert got[t] == free[:lacking]
        assert len(got[t]) == min(lacking, len(set(range(pool_size)) - set(ids) - {t}))


def test_fill_keeps_groups_and_fields_apart(spark):
    pool = spark.createDataFrame([("a", 1, "x"), ("a", 1, "w"), ("a", 2, None), ("b", 3, "z")], "g string, p long, name string")
    lists = spark.createDataFrame([(1, "a", []), (2, "b", ["q"]), (3, "c", [])], "t long, g string, have array<string>")
    done = fill.fill_lists(lists, fill.pool_of(pool, "p", ["g"], ["name"]), ["t"], "have", 3, 1, other_ids=True)
    got = {r["t"]: sorted((x["p"], x["name"]) for x in r["fill"]) for r in done.collect()}
    assert got == {1: [(1, "w"), (2, None)], 2: [(3, "z")], 3: []}


def test_expansion(spark):
    played = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 99, 1)], "user_id long, item_id long, rank int")
    members = spark.createDataFrame(
        [(5, 11, 0), (5, 12, 1), (5, 10, 2), (5, 13, 3), (5, 12, 4), (6, 14, 0)],
        "catalog_id long, content_id long, position int",
    )
    rows = fill.expand_best(played, members, fill.pool_of(members, "content_id"), 3, 1).collect()
    lists = {u: [(r["item_id"], r["source"]) for r in sorted((r for r in rows if r["user_id"] == u), key=lambda r: r["rank"])] for u in (1, 2)}
    assert lists[1][:2] == [(12, "catalog"), (13, "catalog")]
    assert lists[1][2][1] == "pool" and lists[1][2][0] not in (12, 13)
    assert [s for _, s in lists[2]] == ["pool"] * 3 and len({i for i, _ in lists[2]}) == 3


def test_expansion_passes_any_number_of_ranked_films(spark):
    members = spark.range(6000).select(F.lit(7).cast("bigint").alias("catalog_id"), F.col("id").alias("content_id"), F.col("id").cast("int").alias("position"))
    played = spark.range(5000).select(F.lit(1).cast("bigint").alias("user_id"), F.col("id").alias("item_id"), (F.col("id") + 1).cast("int").alias("rank"))
    played = played.unionAll(spark.createDataFrame([(2, 5999, 1), (2, 0, 2)], "user_id long, item_id long, rank int"))
    rows = fill.unseen_of_best(played, members, 20).collect()
    assert sorted((r["rank"], r["item_id"]) for r in rows if r["user_id"] == 1) == [(i + 1, 5000 + i) for i in range(20)]
    assert sorted((r["rank"], r["item_id"]) for r in rows if r["user_id"] == 2) == [(i + 1, 1 + i) for i in range(20)]


def test_points_meet_their_intervals_once(spark):
    rng = random.Random(4)
    spans = [(i, a := rng.randrange(1 << 17), min(1 << 17, a + rng.choice([0, 1, 2, 3, 60, 3600, 1 << 17]))) for i in range(300)]
    spans += [(300, 0, 1 << 17), (301, 5, 5), (302, 9, 4), (303, -50, 10), (304, 131000, 200000), (305, None, 7)]
    points = [0, 5, 9, 10, 131071, *[rng.randrange(1 << 17) for _ in range(100)]]
    left = spark.createDataFrame(spans, "i long, a long, b long")
    right = spark.createDataFrame([(p,) for p in points] + [(None,), (-1,), (1 << 17,)], "p long")
    got = sorted((r["i"], r["p"]) for r in join_points(left, right, "a", "b", "p").collect())
    assert got == sorted((i, p) for i, a, b in spans for p in points if a is not None and a <= p < b)
    most = left.select(F.size(segments(F.greatest("a", F.lit(0)), F.least("b", F.lit(1 << 17)))).alias("n")).agg(F.max("n")).first()[0]
    assert most <= 34
