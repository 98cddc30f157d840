from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from viewloom.operators import hierarchy
from viewloom.plans.reports import as_ids, completion_histogram, series_completion
from viewloom.sources import logs, metadata

CATALOG = "catalog_id bigint, parent_id bigint, name string, type int, sort_index string"


def test_window_ends_yesterday():
    days = logs.window_days("2024-01-03", 2)
    assert days == [dt.date(2024, 1, 2), dt.date(2024, 1, 1)]


def write_day(folder, day, lines):
    (folder / f"{day}.csv").write_text("\n".join(lines) + "\n")


def test_daily_logs(spark, tmp_path):
    line = "x,x,x,x,x,{content},{user},{key}"
    write_day(tmp_path, "20240101", [line.format(content=1, user=2, key="k"), "too,short"])
    write_day(tmp_path, "20240103", [line.format(content=9, user=9, key="k")])
    read = logs.read_daily_logs(spark, str(tmp_path), "vsp_vod", "2024-01-03", 5)
    assert read.columns == ["content_id", "user_id", "product_key"]
    assert [tuple(r) for r in as_ids(read, "user_id", "content_id").collect()] == [(1, 2, "k")]
    empty = logs.read_daily_logs(spark, str(tmp_path), "ott_play", "2030-01-01", 2, allow_empty=True)
    assert empty.count() == 0
    with pytest.raises(AnalysisException):
        logs.read_daily_logs(spark, str(tmp_path), "ott_play", "2030-01-01", 2)


def test_quotes_are_part_of_a_field(spark, tmp_path):
    write_day(tmp_path, "20240101", ['a,b,"c,d,e,78,89,prod,x'])
    read = logs.read_daily_logs(spark, str(tmp_path), "vsp_vod", "2024-01-02", 1).first()
    assert tuple(read) == ("78", "89", "prod")


def test_log_positions(spark, tmp_path):
    write_day(tmp_path, "20240101", [",".join(f"f{i}" for i in range(14))])
    read = {
        layout: logs.read_daily_logs(spark, str(tmp_path), layout, "2024-01-02", 1).first().asDict()
        for layout in logs.LOG_LAYOUTS
    }
    assert read["xor_vod"] == {"content_id": "f0", "watch_seconds": "f5", "user_id": "f11"}
    assert read["vsp_vod"] == {"content_id": "f5", "user_id": "f6", "product_key": "f7"}
    assert read["ott_play"] == {"content_id": "f3", "flag4": "f4", "play_type": "f5", "user_id": "f7"}


def test_ratings(spark, tmp_path):
    (tmp_path / "r.dat").write_text("1473::3283::3::978300760\n1564::3283::3.5::1\n")
    rows = logs.read_ratings(spark, str(tmp_path / "r.dat")).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [("1473", "3283", 3.0), ("1564", "3283", 3.5)]


def test_window_predicate_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = events.where(logs.in_timestamp_window(F.col("ts"), "2024-01-31", 10)).select("user_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_partition_window(spark, tmp_path):
    days = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "d string, v int")
    days.select(F.col("d").cast("date").alias("dt"), "v").write.partitionBy("dt").parquet(str(tmp_path / "p"))
    read = spark.read.parquet(str(tmp_path / "p")).where(logs.in_window(F.col("dt"), "2024-01-03", 1))
    assert [r["v"] for r in read.collect()] == [2]
    assert "PartitionFilters: [isnotnull(dt" in read._jdf.queryExecution().executedPlan().toString()


def test_bounds_query():
    assert metadata.id_bounds_query("t", "id") == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM t) bounds"


def test_episode_map(spark):
    catalog = spark.createDataFrame(
        [(10, 1, "A", 1, "1;;2"), (11, 1, "B", 1, "2;3;x"), (12, 1, "C", 0, "4"), (13, 1, "D", 1, ""), (14, 1, "E", 1, None)],
        CATALOG,
    )
    rows = {r["content_id"]: (r["series_id"], r["n_episodes"], r["series_name"]) for r in metadata.episode_map(catalog).collect()}
    assert rows == {1: (10, 2, "A"), 2: (11, 3, "B"), 3: (11, 3, "B")}
    members = {tuple(r) for r in metadata.catalog_members(catalog).collect()}
    assert members == {(10, 1, 0), (10, 2, 1), (11, 2, 0), (11, 3, 1), (12, 4, 0)}


def test_subtree_ends_on_cycles(spark):
    catalog = spark.createDataFrame(
        [
            (10, 1, "a", 0, "20;5"),
            (20, 10, "b", 0, "30;6"),
            (30, 20, "c", 0, "20;7;5"),
            (40, 2, "other", 0, "8"),
            (50, 1, "leafless", 0, None),
        ],
        CATALOG,
    )
    assert {r[0] for r in hierarchy.subtree(catalog, 1).collect()} == {20, 30, 5, 6, 7}
    assert hierarchy.subtree(catalog, 99).count() == 0


def test_completion_counts_episodes_once(spark):
    catalog = spark.createDataFrame([(10, 1, "A", 1, "1;2;3;4")], CATALOG)
    plays = spark.createDataFrame([("7", "1"), ("7", "1"), ("7", "2"), ("8", "9"), ("u", "1")], "user_id string, content_id string")
    done = series_completion(plays, metadata.episode_map(catalog))
    assert [tuple(r) for r in done.collect()] == [(7, 10, 4, 2, 0.5)]
    assert [tuple(r) for r in completion_histogram(done).collect()] == [(0.5, 1, 1, 1.0)]


def test_level_rows(spark):
    df = spark.createDataFrame([(1, "5", "five", "0", "none"), (2, "", "b", "6", "six")], "id int, l1 string, n1 string, l2 string, n2 string")
    rows = {tuple(r) for r in metadata.level_rows(df, [("l1", "n1"), ("l2", "n2")], ["id"]).collect()}
    assert rows == {(1, 1, "5", "five"), (2, 2, "6", "six")}


@pytest.mark.parametrize("table", ["region"])
def test_read_table(spark, table):
    assert metadata.read_table(spark, table, "/root/testdata/sf0.001").count() == 5
