"""Numbers beside other numbers, all forms of a value, hostile texts, and the exact way back."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import FOLDER
from tests.llm.test_operators import luhn, lower
from viewloom.llm import pseudonyms
from viewloom.llm.queries import QUERIES

KEY = "k"
CARD = "4111111111111111"
#: A text and the parts of it that must be gone.
HIDDEN = {
    "4111 1111 1111 1111 123": ["4111 1111 1111 1111"],
    "4111111111111111 12/27": [CARD],
    "2 4111 1111 1111 1111": ["4111 1111 1111 1111"],
    "4111111111111111 7": [CARD],
    "1234 4111 1111 1111 1111 555-123-4567": ["4111 1111 1111 1111", "555-123-4567"],
    "GB12 4111 1111 1111 1111 12": ["4111 1111 1111 1111"],
    "card 4111-1111-1111-1111 12ab": ["4111-1111-1111-1111"],
    "3782 822463 10005": ["3782 822463 10005"],
    "ES91 2100 0418 4502 0005 1332 EUR": ["2100 0418 4502 0005 1332"],
    "(DE89370400440532013000)": ["370400440532013000"],
    "12/25/2020": ["12/25/2020"],
    "2020/12/25": ["2020/12/25"],
    "+44 20 7946 0958": ["20 7946 0958"],
    "call 2435555526 now": ["2435555526"],
    "write to joe.b@mail.example.com.": ["joe.b@"],
}


def rewritten(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for _, r in sorted((r.doc_id, r) for r in pseudonyms.pseudonymise(df, KEY, **options).collect())]


def test_a_value_is_found_whatever_stands_beside_it(spark):
    for text, row in zip(HIDDEN, rewritten(spark, list(HIDDEN)), strict=True):
        assert all(part not in row.text for part in HIDDEN[text]), row.text
        assert len(row.text) == len(text) and sum(row[f"n_{k}"] for k in pseudonyms.KINDS) == len(HIDDEN[text])
        for number in re.findall(r"(?<![0-9A-Z])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])", row.text if row.n_card else ""):
            if number in text:
                continue
            assert luhn(re.sub("[ -]", "", number)) or "1234" in number or "GB" in text


def test_one_value_has_one_pseudonym_in_all_forms(spark):
    forms = [
        ["4111 1111 1111 1111", "4111-1111-1111-1111", CARD],
        ["243-555-5526", "(243) 555-5526", "2435555526", "+1 243 555 5526", "+12435555526"],
        ["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958"],
        ["GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"],
        ["Joe.B@x.org", "joe.b@x.org"],
    ]
    for texts in forms:
        rows = [re.sub("[^0-9A-Za-z]", "", r.text) for r in rewritten(spark, texts)]
        if texts[0].startswith("243"):
            rows = [r[-10:] for r in rows]
        assert len(set(rows)) == 1 and rows[0] != re.sub("[^0-9A-Za-z]", "", texts[0]).lower()
    dates = [r.text for r in rewritten(spark, ["2020-12-25", "2020/12/25", "25.12.2020", "25/12/2020", "12/25/2020"])]
    y, m, d = dates[0].split("-")
    assert dates == [f"{y}-{m}-{d}", f"{y}/{m}/{d}", f"{d}.{m}.{y}", f"{d}/{m}/{y}", f"{m}/{d}/{y}"]


def test_different_addresses_stay_different(spark):
    texts = ["é@ex.com", "ö@ex.com", "x@ex.com", "aé@ex.com", "aö@ex.com", "a@ex.com", "b@ex.com", "a.b@ex.com", "ab@ex.com"]
    found = [r.text for r in rewritten(spark, texts)]
    assert len(set(found)) == len(texts) and found[0] == texts[0] and found[3][1:] == "é@ex.com"


def test_everything_else_stays_as_it_is(spark):
    texts = [
        "\u0001 \u0001\u0002 \u0001\u0003 \u0002 \u0006\u0001\u0006 $0 \\1",
        f"\u0001{CARD}\u0001\u0003",
        "4111111111111112 and 0123456789, 1234567890123, 99/99/2020, 2021-02-30, 000-12-3456, 999.1.1.1",
        "AB12 CD34, XX00 1234 5678 9012, v1.2.3.4.5, 1,234,567,890",
        "",
        None,
        "a@b, @x.org, a@.org, 13 4111",
    ]
    rows = rewritten(spark, texts)
    assert [r.text for i, r in enumerate(rows) if i != 1] == [t for i, t in enumerate(texts) if i != 1]
    assert rows[1].text[0] == "\u0001" and rows[1].text[-2:] == "\u0001\u0003" and luhn(rows[1].text[1:-2]) and rows[1].n_card == 1


def test_spans_lead_back_exactly(spark, documents):
    texts = [*HIDDEN, "none", None, "", f"\u0001 {CARD} \u0001", "1234 " * 30 + "4111 1111 1111 1111 " * 5, "28.02.1999 1.2.2020 02/28/1999"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = pseudonyms.pseudonymise(df, KEY, spans="found")
    back = {r.doc_id: r.text for r in pseudonyms.restored(done, KEY, "found").collect()}
    assert back == dict(enumerate(texts))
    for row in done.collect():
        assert [s.kind for s in row.found].count("card") == row.n_card
    whole = pseudonyms.restored(pseudonyms.pseudonymise(documents, KEY, spans="found"), KEY, "found")
    assert {r.doc_id: lower(r.text) for r in whole.collect()} == {r.doc_id: lower(r.text) for r in documents.collect()}


HOSTILE = ["a@" + "b." * 2500 + "com", *[part * (200_000 // len(part)) for part in (".", "1", " ", "@", "-", "a", "1 ", "1-", "1234 ", "a@", "a.", "+1", "1.", "a@b.", "AB12", "AB12 ", "12/", "GB82 ", "(243) ")]]


def test_hostile_texts_neither_fail_nor_hang(spark):
    import time

    started = time.time()
    rows = rewritten(spark, HOSTILE)
    assert [r.text for r in rows] == HOSTILE and time.time() - started < 120
    many, = rewritten(spark, ["4111 1111 1111 1111 " * 500])
    assert many.n_card == 500 and many.text == many.text[:20] * 500


def test_ten_digits_stay_a_phone_or_none(spark):
    good = spark.range(300).select((F.col("id") * 7919 % 800 + 200).cast("string").alias("a"), F.lpad((F.col("id") * 31 % 10000).cast("string"), 4, "0").alias("l"))
    digits = good.select(F.concat("a", F.lit("555"), "l").alias("d")).union(spark.range(300).select(F.concat(F.lit("0"), F.lpad((F.col("id") * 7919).cast("string"), 9, "0"))))
    moved = digits.select("d", pseudonyms._ten_digits(F.col("d"), KEY, False).alias("x")).cache()
    rows = moved.collect()
    assert all(bool(re.match("[2-9]..[2-9]", r.d)) == bool(re.match("[2-9]..[2-9]", r.x)) and len(r.x) == 10 for r in rows)
    assert len({r.x for r in rows}) == len({r.d for r in rows})
    assert all(r.d == r.back for r in moved.select("d", pseudonyms._ten_digits(F.col("x"), KEY, True).alias("back")).collect())


def test_without_a_key_every_run_has_its_own(spark):
    assert spark.conf.get("spark.viewloom.pseudonyms.key", None) is None
    first, second = ({r.doc_id: r.text for r in QUERIES["op5_pseudonyms"](spark, FOLDER).collect()} for _ in range(2))
    assert first != second
    spark.conf.set("spark.viewloom.pseudonyms.key", "one of many")
    try:
        first, second = ({r.doc_id: r.text for r in QUERIES["op5_pseudonyms"](spark, FOLDER).collect()} for _ in range(2))
        assert first == second
    finally:
        spark.conf.unset("spark.viewloom.pseudonyms.key")
    with pytest.raises(ValueError):
        pseudonyms.pseudonymise(spark.range(0).select(F.lit("").alias("text")), "")
