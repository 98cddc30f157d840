"""What keeps disk, memory and reads of a task bounded on larger tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from viewloom import session
from viewloom.operators import airtime, cooccurrence, factors, shortlist, spans
from viewloom.sources import bucketed
from workload import standins
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_similarity_deals_ratings_and_not_pairs(spark):
    rows = [(u, i, float((u * i) % 7)) for u in range(30) for i in range(u % 3, 40)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    got = cooccurrence.pair_moments(df, slice_items=15, task_pairs=1000)
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", _plan(got))
    assert not [d for d in dealt if "_item" in d and "_with" in d or "item1" in d]
    assert any(re.match(r"_item#\d+L?, 2[0-9]\b", d) for d in dealt)
    left, right = df.toDF("user_id", "item1", "x"), df.toDF("user_id", "item2", "y")
    raters = df.groupBy("item_id").count()
    want = (
        left.join(right, "user_id").where("item1 < item2").groupBy("item1", "item2")
        .agg(F.expr("cast(count(*) as double) n"), F.expr("sum(x * y) xy"), F.sum("x"), F.sum("y"), F.expr("sum(x * x) xx"), F.expr("sum(y * y) yy"))
        .join(raters.toDF("item1", "n1"), "item1").join(raters.toDF("item2", "n2"), "item2")
    )
    names = ["item1", "item2", "n", "xy", "x", "y", "xx", "yy", "n1", "n2"]
    want = want.toDF("item2", "item1", *names[2:]).select(*names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, want.collect()))


def test_cinema_facts_do_not_pair_users_with_their_catalogue(spark):
    plan = QUERIES["cinema_rerank_facts"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan


def test_buckets_follow_the_rows(spark, monkeypatch):
    assert [bucketed.buckets_for(n) for n in (0, 4_000_000, 4_000_001, 36_000_000)] == [8, 8, 16, 128]
    monkeypatch.setattr(bucketed, "buckets_for", lambda rows: 8 * (1 + (rows > 1000)))
    for name in ("district_counts_bucketed", "topn_by_district_bucketed"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert "Bucketed: true" in plan and "out of 16" in plan


def test_minute_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(airtime, "TASK_ROWS", 100)
    schedule, audience = standins.schedule(spark, SMALL), standins.frame(spark, SMALL, "audience")
    plan = _plan(airtime.live_lists(schedule, audience, standins.LIVE_DAY))
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(channel_id#\d+, start_time#\d+, (\d+)\)", plan)]
    assert dealt and min(dealt) > 8
    groups = re.findall(r"hashpartitioning\(minute#\d+, category#\d+[^,]*, (\d+)\)", plan)
    assert groups and int(groups[0]) == 2 * dealt[0] and "channel_id#" not in "".join(re.findall(r"hashpartitioning\(minute[^)]*", plan))


def test_moments_meet_counts_and_not_programmes(spark):
    programmes = [("a", i % 60, 60 + i % 60, "x" if i % 3 else "y") for i in range(600)] + [("b", 5, 5, "x"), (None, 0, 100, "z")]
    spans_ = spark.createDataFrame(programmes, "name string, _f bigint, _t bigint, kind string")
    moments = spark.createDataFrame([(i, i % 130) for i in range(400)] + [(1000, None)], "id bigint, second bigint")
    got = spans.count_points(spans_, moments, "_f", "_t", "second", ["kind"], F.count("name"), "n")
    each = spans.join_points(spans_, moments, "_f", "_t", "second")
    want = each.groupBy("id", "second", "kind").agg(F.count("name").alias("n"))
    columns = ["id", "second", "kind", "n"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    plan = QUERIES["channels_on_air_at_events"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    last = max(i for i, line in enumerate(lines) if "_segment" in line and "Join" in line)
    assert "Aggregate" in lines[last + 1]


def test_draws_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(shortlist, "TASK_DRAWS", 100)
    rows = spark.range(300).selectExpr("id AS content_id", "id % 3 AS place", "concat('t', id % 50) AS title")
    lists = shortlist.recommend_by_draw(rows, rows, ["place"], [F.col("content_id")], 6, 1, fields=["title"])
    dealt = re.findall(r"hashpartitioning\(content_id#\d+L, (\d+)\), REPARTITION_BY_NUM", _plan(lists))
    assert "18" in dealt
    assert lists.groupBy("content_id").count().agg(F.count("*"), F.max("count")).first() == (300, 6)


def _rated(spark):
    rows = [(u, i, 1 + u * i % 5) for u in range(40) for i in range(u % 4, 30, 1 + u % 3)]
    return factors.with_int_ids(spark.createDataFrame(rows, "user_id bigint, item_id bigint, plays bigint"))


def test_blocks_follow_the_ratings(spark, monkeypatch):
    sizes = (0, 600_000, 2_000_000, 2_000_001, 300_000_000, 300_000_001, 5_000_000_000)
    assert [factors.blocks_for(n) for n in sizes] == [5, 5, 5, 12, 12, 24, 384]
    rated = _rated(spark)
    parts = [factors.fit(rated, rank=2, iterations=1).itemFactors.rdd.getNumPartitions()]
    monkeypatch.setattr(factors, "FEW_RATINGS", 100)
    parts += [factors.fit(rated, rank=2, iterations=1, blocks=b).itemFactors.rdd.getNumPartitions() for b in (None, 5)]
    assert parts == [5, 12, 5]


def test_scores_of_a_user_move_once(spark):
    rated = _rated(spark)
    model = factors.fit(rated, rank=4, iterations=5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = factors.rerank_played(rated.select("user_id", "item_id", "plays"), 5, rank=4, iterations=5)
        dealt = re.findall(r"hashpartitioning\((\w+)#", _plan(ranked))
        assert sorted(dealt) == ["_item", "_item", "_user", "_user"]
        got = {(r["user_id"], r["item_id"]): r["score"] for r in factors.played_scores(model, rated).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {(r["user_id"], r["item_id"]): r["prediction"] for r in model.transform(rated).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 for p in want)


def test_facts_of_lists_deal_lists_once(spark):
    plan = QUERIES["als_customers_facts"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\((list_key#[^)]*)\)", plan)
    assert len(dealt) == 1 and "item_id" not in dealt[0]


def _pair_sums(rows):
    """Moments of every pair of items that a user rated, item by item."""
    raters, by_user, sums = {}, {}, {}
    for user, item, rating in rows:
        raters[item] = raters.get(item, 0) + 1
        if user is not None:
            by_user.setdefault(user, []).append((item, rating))
    for rated in by_user.values():
        for i, a in rated:
            for j, b in rated:
                if i < j:
                    had = sums.setdefault((i, j), [0.0] + [None] * 5)
                    had[0] += 1
                    for at, x in enumerate((None if a is None or b is None else a * b, a, b, a and a * a, b and b * b), 1):
                        had[at] = had[at] if x is None else x + (had[at] or 0)
    return sorted((*pair, *had, raters[pair[0]], raters[pair[1]]) for pair, had in sums.items())


def test_pairs_travel_as_one_number_each(spark):
    few = [(u, 9_000_000_000 + i * i, None if u == i else float((u * i) % 7)) for u in range(20) for i in range(u % 3, 25)]
    few += [(None, 9_000_000_001, 3.0), (None, 9_000_000_004, 3.0)]
    many = [(u, i, u + i / 1000) for u in range(20) for i in range(u % 3, 25)]
    wide = [(u, i * (1 << 58), float(i)) for u in range(5) for i in range(-20, 20, 3)]
    names = ["item1", "item2", "n", "xy", "x", "y", "xx", "yy", "n1", "n2"]
    for rows, kind in ((few, "int"), ([(u, i * 10_000_000, r) for u, i, r in many[:40]] + few, "bigint"), (many, None), (wide, None)):
        rows = [r for r in rows if r[2] != 0.0]
        df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
        made = cooccurrence._entry(df).made
        assert list(made) == (["code"] if kind else ["item_id", "rating"])
        assert kind is None or df.select(made["code"]).dtypes[0][1] == kind
        for slice_items in (1000, 4):
            got = sorted(map(tuple, cooccurrence.pair_moments(df, slice_items).select(names).collect()))
            want = _pair_sums(rows)
            assert [g[:3] + g[8:] for g in got] == [w[:3] + w[8:] for w in want]
            assert all(a == b or abs(a - b) < 1e-6 for g, w in zip(got, want) for a, b in zip(g[3:8], w[3:8]))


def test_written_tables_leave_no_shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = files.getAllFiles().size()
        written = session.cut_lineage(spark.range(1000).selectExpr("id % 10 AS k", "id").groupBy("k").agg(F.max("id").alias("m")))
        assert files.getAllFiles().size() <= before and written.count() == 10
        assert spark.conf.get(session.REMOVE_SHUFFLES) == "false"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_blocks_follow_the_memory_of_a_task(spark, monkeypatch):
    sizes = (0, 2_000_000, 36_000_000, 120_000_000, 120_000_001, 216_000_000, 240_000_001)
    assert [factors.training_blocks(n) for n in sizes] == [5, 5, 12, 12, 24, 24, 48]
    monkeypatch.setattr(factors, "TASK_RATINGS", 100)
    rated = _rated(spark)
    assert 500 < rated.count() <= 1000
    assert factors.fit(rated, rank=2, iterations=1).itemFactors.rdd.getNumPartitions() == 10


def test_training_leaves_the_memory_to_its_tasks(spark):
    context = spark.sparkContext._jsc.sc()
    before = {info.id() for info in context.getRDDStorageInfo()}
    factors.fit(_rated(spark), rank=2, iterations=4)
    kept = [info for info in context.getRDDStorageInfo() if info.id() not in before]
    assert kept and all(info.memSize() == 0 and info.diskSize() > 0 for info in kept)


def test_reranking_keeps_one_table(spark):
    counts = _rated(spark).select("user_id", "item_id", "plays")
    before = session.written_tables()
    ranked = factors.rerank_played(counts, 3, rank=2, iterations=1)
    assert session.written_tables() == before + 1 and ranked.groupBy("user_id").count().agg(F.max("count")).first()[0] == 3


def test_products_find_predicted_rows_by_item(spark):
    rated = _rated(spark)
    model = factors.fit(rated, rank=2, iterations=1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(factors.factor_products(model, model.transform(rated)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [c for c in re.findall(r"hashpartitioning\((\w+)#", plan) if c.startswith("_")]
    assert sorted(dealt) == ["_item", "_item", "_user", "_user", "_user"]


def test_queries_of_the_factor_model_keep_nothing_in_memory(spark):
    context = spark.sparkContext._jsc.sc()
    before = {info.id() for info in context.getRDDStorageInfo()}
    for name in ("als_customers_facts", "als_fit_facts"):
        assert QUERIES[name](spark, SMALL).count() > 0
    assert all(info.memSize() == 0 for info in context.getRDDStorageInfo() if info.id() not in before)
