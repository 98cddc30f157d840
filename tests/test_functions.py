from __future__ import annotations

import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from viewloom.functions import payloads, predicates, scalars, similarity


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, expr, kind="string"):
    rows = one_column(spark, values, kind).select("i", expr.alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_missing_texts(spark):
    values = ["", "  ", "null", "NULL", "无", None, "x", "nullable"]
    assert apply(spark, values, scalars.blank_to_null(F.col("v"))) == [None] * 6 + ["x", "nullable"]


def test_digits(spark):
    values = ["12", "", "1a", " 1", "12\n", "٣", None]
    assert apply(spark, values, scalars.is_digits(F.col("v"))) == [True, False, False, False, False, False, None]


def test_id_length(spark):
    assert apply(spark, ["1234567890", "12345678901"], predicates.valid_ids(F.col("v"), max_length=11)) == [True, False]


def test_dates(spark):
    values = ["2015-03-04 10:11:12", "2015-03-04", "", "bad", None]
    assert apply(spark, values, scalars.day_number(F.col("v"))) == [20150304, 20150304, None, None, None]


def test_bins(spark):
    values = [-0.1, 0.0, 0.1, 0.1000001, 0.9, 0.95, 1.0, 1.2, float("nan")]
    want = [1.0, 0.1, 0.1, 0.2, 0.9, 1.0, 1.0, 1.0, 1.0]
    assert apply(spark, values, scalars.completion_bin(F.col("v")), "double") == want


def test_seconds(spark):
    assert apply(spark, ["60", "61", "x", ""], predicates.watched_longer_than(F.col("v"))) == [False, True, None, None]


def test_genre_codes(spark):
    values = ["1", "110", "3,41", "2", None, ""]
    assert apply(spark, values, predicates.genre_allowed(F.col("v"))) == [True, False, False, True, False, True]


def test_newer_than_is_strict(spark):
    values = ["2014-01-01", "2014-01-02", None]
    assert apply(spark, values, predicates.newer_than(F.col("v").cast("date"), "2016-01-01", 2)) == [False, True, None]


def test_split_ids_drops_blanks(spark):
    assert apply(spark, ["a;;b; ", "", None, "7"], scalars.split_ids(F.col("v"))) == [["a", "b"], [], None, ["7"]]


def test_text_helpers(spark):
    assert apply(spark, ["Some(12)"], scalars.digits_only(F.col("v"))) == ["12"]
    assert apply(spark, ["a,b", "c"], scalars.first_code(F.col("v"))) == ["a", "c"]
    assert apply(spark, ["2", "3"], scalars.series_flag(F.col("v"))) == [1, 0]
    assert apply(spark, [None, "n"], scalars.name_or_blank(F.col("v"))) == [" ", "n"]
    assert apply(spark, ["", "n"], scalars.default_if_blank(F.col("v"))) == ["1", "n"]


def test_payload_keeps_empty_fields(spark):
    row = spark.range(1).select(
        payloads.item_payload(F.col("id"), F.lit(1), F.lit(None).cast("string")).alias("p"),
        payloads.live_payload(F.array(F.lit("c")), F.array(F.struct(F.lit(1).alias("m")))).alias("l"),
        payloads.list_key("A", F.col("id"), F.lit(None).cast("string"), "z").alias("k"),
    ).first()
    assert json.loads(row["p"]) == {
        "assetId": "", "assetname": "", "assetpic": "", "movieID": "0", "providerId": "", "rank": "1"
    }
    assert json.loads(row["l"]) == {"rec_livelist": ["c"], "rec_vodlist": [{"m": 1}]}
    assert row["k"] == "A_0_z"


def measures(spark, pairs):
    n = float(len(pairs))
    sums = [n] + [float(sum(f(x, y) for x, y in pairs)) for f in (
        lambda x, y: x * y, lambda x, y: x, lambda x, y: y, lambda x, y: x * x, lambda x, y: y * y)]
    names = ["n", "xy", "x", "y", "xx", "yy"]
    df = spark.createDataFrame([tuple(sums)], names)
    c = {k: F.col(k) for k in names}
    return df.select(
        similarity.correlation(*[c[k] for k in names]).alias("corr"),
        similarity.cosine(c["xy"], c["xx"], c["yy"]).alias("cos"),
        similarity.correlation(c["n"], c["xy"], c["y"], c["x"], c["yy"], c["xx"]).alias("flipped"),
    ).first()


def test_constant_ratings_have_no_correlation(spark):
    assert measures(spark, [(3, 1), (3, 2)])["corr"] is None
    assert measures(spark, [(3, 1)])["corr"] is None


@settings(max_examples=8, deadline=None)
@given(hs.lists(hs.tuples(hs.integers(0, 5), hs.integers(0, 5)), min_size=1, max_size=12))
def test_measures_stay_in_range(spark, pairs):
    row = measures(spark, pairs)
    if row["corr"] is not None:
        assert -1 - 1e-9 <= row["corr"] <= 1 + 1e-9
        assert math.isclose(row["corr"], row["flipped"], abs_tol=1e-12)
    if row["cos"] is not None:
        assert 0 <= row["cos"] <= 1 + 1e-9


def test_shrunk_correlation_and_jaccard(spark):
    row = spark.range(1).select(
        similarity.regularized_correlation(F.lit(0.5), F.lit(10.0)).alias("reg"),
        similarity.jaccard(F.lit(2.0), F.lit(3), F.lit(4)).alias("jac"),
    ).first()
    assert row["reg"] == pytest.approx(0.25)
    assert row["jac"] == pytest.approx(0.4)
