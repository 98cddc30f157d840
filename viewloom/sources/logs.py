"""Play logs, ratings and earlier results."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.sources.schemas import COMPLETION, LOG_LAYOUTS, RATINGS


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def window_days(as_of: dt.date | str, span: int) -> list[dt.date]:
    """The ``span`` whole days that end yesterday, newest first."""
    end = as_date(as_of)
    return [end - dt.timedelta(days=i) for i in range(1, span + 1)]


def in_window(day: Column, as_of: dt.date | str, span: int) -> Column:
    """Range predicate on a date or timestamp column; literal bounds reach the scan and prune partitions."""
    end = as_date(as_of)
    start = end - dt.timedelta(days=span)
    return (day >= F.lit(start)) & (day < F.lit(end))


def in_timestamp_window(ts: Column, as_of: dt.date | str, span: int) -> Column:
    """The same for timestamps without zone: bounds of the column's own type keep the push-down."""
    end = as_date(as_of)
    start = end - dt.timedelta(days=span)
    lower = F.expr(f"TIMESTAMP_NTZ '{start} 00:00:00'")
    upper = F.expr(f"TIMESTAMP_NTZ '{end} 00:00:00'")
    return (ts >= lower) & (ts < upper)


def split_lines(lines: DataFrame, positions: dict[str, int], separator: str = ",") -> DataFrame:
    """Text columns of the fields at ``positions``; ``lines`` has the column ``value``.

    A line is cut at every separator; quotes have no meaning. Fields that a line lacks are NULL.
    """
    fields = F.split("value", re.escape(separator), -1)
    return lines.select(*[F.get(fields, F.lit(at)).alias(name) for name, at in positions.items()])


def log_lines(lines: DataFrame, layout: str) -> DataFrame:
    """The columns of a daily log of the given layout."""
    return split_lines(lines, LOG_LAYOUTS[layout])


def rating_lines(lines: DataFrame) -> DataFrame:
    """``user::item::rating::...``; further fields are ignored, a rating that is no number is NULL."""
    return _typed(split_lines(lines, {name: i for i, name in enumerate(RATINGS.names)}, "::"), RATINGS)


def completion_lines(lines: DataFrame) -> DataFrame:
    """Earlier written completion rows."""
    return _typed(split_lines(lines, {name: i for i, name in enumerate(COMPLETION.names)}), COMPLETION)


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_daily_logs(
    spark: SparkSession, folder: str, layout: str, as_of: dt.date | str, span: int, allow_empty: bool = False
) -> DataFrame:
    """Read ``yyyyMMdd.csv`` files of the window; days without a file are skipped.

    Lines with too few fields give NULL ids, which the id predicates drop. A window without any file is
    an error, for the folder may be wrong, unless ``allow_empty`` is set.
    """
    days = ",".join(day.strftime("%Y%m%d") for day in window_days(as_of, span))
    try:
        lines = spark.read.text(f"{folder}/{{{days}}}.csv")
    except AnalysisException as error:
        if not allow_empty or error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return log_lines(lines, layout)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return rating_lines(spark.read.text(path))


def read_completion(spark: SparkSession, path: str) -> DataFrame:
    return completion_lines(spark.read.text(path))
