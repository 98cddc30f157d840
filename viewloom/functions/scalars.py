"""Cleaning, dates, flags, bins and text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that mean "no value" in the source tables.
MISSING_TEXTS = ["", "null", "NULL", "无"]

# Upper edges of the completion bins; everything else falls into the last bin.
BIN_EDGES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
LAST_BIN = 1.0


def blank_to_null(col: Column) -> Column:
    """NULL for every spelling of "missing"."""
    text = F.trim(col.cast("string"))
    return F.when(~text.isin(MISSING_TEXTS), col)


def is_digits(col: Column) -> Column:
    """True when the whole text consists of ASCII digits."""
    return col.cast("string").rlike(r"\A[0-9]+\z")


def shorter_than(col: Column, length: int = 11) -> Column:
    return F.length(col.cast("string")) < length


def day_of(col: Column) -> Column:
    """Date in front of the first blank; NULL when there is none that can be read."""
    return F.try_to_date(F.substring_index(col.cast("string"), " ", 1))


def day_number(col: Column) -> Column:
    """The same date as the integer yyyyMMdd."""
    return F.date_format(day_of(col), "yyyyMMdd").cast("int")


def first_code(col: Column) -> Column:
    """First entry of a comma list."""
    return F.substring_index(col, ",", 1)


def series_flag(type_code: Column, series_code: str = "2") -> Column:
    return F.when(type_code == series_code, F.lit(1)).otherwise(F.lit(0))


def completion_bin(ratio: Column) -> Column:
    """Upper edge of the bin that holds ``ratio``; below 0, above 0.9 and NaN give 1.0."""
    binned = F.when(~(ratio >= 0.0) | F.isnan(ratio), F.lit(LAST_BIN))
    for edge in BIN_EDGES:
        binned = binned.when(ratio <= edge, F.lit(edge))
    return binned.otherwise(F.lit(LAST_BIN))


def default_if_blank(col: Column, default: str = "1") -> Column:
    return F.when(col == "", F.lit(default)).otherwise(col)


def name_or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(" "))


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col.cast("string"), "[^0-9]", "")


def split_ids(col: Column) -> Column:
    """Ids of a ``a;b;c`` list without blank entries."""
    return F.filter(F.transform(F.split(col, ";"), lambda x: F.trim(x)), lambda x: x != "")


def csv_row(*cols: Column) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in cols])


def draw_order(seed: int | str, *cols: Column) -> Column:
    """Reproducible random order: a hash of the seed and the ids."""
    parts = [F.lit(str(seed))] + [c.cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def draw_number(seed: int | str, *cols: Column) -> Column:
    """A reproducible random number of 60 bits."""
    return F.conv(F.substring(draw_order(seed, *cols), 1, 15), 16, 10).cast("bigint")
