"""Row predicates of the viewing jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewloom.functions.scalars import is_digits, shorter_than

# Product keys, catalogue roots, level and type codes of the source system.
FREE_VOD_PRODUCT = "ahyuvzq53adjct"
CINEMA_PRODUCT = "ahqhse8x8yr8ex"
FREE_VOD_ROOT = "10046284"
CINEMA_CATALOG = "10001719"
CINEMA_PARENT = "10046284"
SCHOOL_LEVEL = "10001059"
OTT_SCHOOL_TYPE = "21"
OTT_SERIES_TYPE = "2"
PLAY_VOD = "1"
PLAY_LIVE = "2"
HIDDEN_GENRE_CODES = ["11", "20", "41"]


def valid_ids(*ids: Column, max_length: int | None = None) -> Column:
    """All ids are digits and, when asked, shorter than ``max_length``."""
    test = F.lit(True)
    for col in ids:
        test = test & is_digits(col)
        if max_length is not None:
            test = test & shorter_than(col, max_length)
    return test


def watched_longer_than(seconds: Column, minimum: int = 60) -> Column:
    return seconds.cast("string").try_cast("bigint") > minimum


def product_is(product_key: Column, key: str = FREE_VOD_PRODUCT) -> Column:
    return product_key == key


def play_is(play_type: Column, flag: Column, wanted: str = PLAY_VOD) -> Column:
    return (play_type == wanted) & (flag != "")


def genre_allowed(genre: Column, codes: list[str] | None = None) -> Column:
    """No hidden code occurs in the genre text; an unknown genre is not allowed."""
    test = genre.isNotNull()
    for code in codes or HIDDEN_GENRE_CODES:
        test = test & ~genre.contains(code)
    return test


def has_date_and_country(day: Column, country: Column) -> Column:
    return day.isNotNull() & country.isNotNull()


def lacks_date_or_country(day: Column, country: Column) -> Column:
    return day.isNull() | country.isNull()


def newer_than(day: Column, as_of: dt.date | str, years: int | None) -> Column:
    """Strictly younger than ``years`` before ``as_of``; an unknown date never is."""
    if years is None:
        return F.lit(True)
    return day > F.add_months(F.to_date(F.lit(str(as_of))), -12 * years)


def is_series_catalog(type_col: Column, sort_index: Column) -> Column:
    return (type_col == 1) & sort_index.isNotNull() & (sort_index != "")
