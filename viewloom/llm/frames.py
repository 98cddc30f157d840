"""Keeping a table's own columns apart from helper columns, whatever they are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OWN, TEXT = "_in", "_t"


def packed(docs: DataFrame, text: str) -> DataFrame:
    """_in: all columns but ``text``; _t: the text. Helper columns beside these two can't clash."""
    rest = [F.col(c) for c in docs.columns if c != text]
    return docs.select(F.struct(*rest or [F.lit(0).alias("_none")]).alias(OWN), F.col(text).alias(TEXT))


def own(column: str, text: str) -> Column:
    """A column of the table that was packed."""
    return F.col(TEXT) if column == text else F.col(OWN).getField(column)


def unpacked(done: DataFrame, docs: DataFrame, text: str, results: dict[str, Column]) -> DataFrame:
    """The columns of ``docs`` in their order, those with the names of results replaced, and the results."""
    before = [results.get(c, own(c, text)).alias(c) for c in docs.columns]
    return done.select(*before, *[x.alias(name) for name, x in results.items() if name not in docs.columns])
