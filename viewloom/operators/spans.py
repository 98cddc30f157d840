"""Points in intervals, joined on equal keys.

An interval of whole numbers is cut into dyadic segments [i * 2**l, (i + 1) * 2**l): two per level at most, disjoint,
and together the interval. A point lies in one segment of every level, so it meets an interval in exactly one segment. Rows
grow with the intervals times the levels, and never with their lengths; pairs appear only in the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels of segments: numbers from 0 to below 2**LEVELS.
LEVELS = 17


def _shifted(value: Column, level: Column) -> tuple[Column, Column]:
    """value / 2**level, rounded up and down."""
    width = F.pow(F.lit(2.0), level).cast("bigint")
    down = F.floor(value / width).cast("bigint")
    return F.ceil(value / width).cast("bigint"), down


def segments(start: Column, end: Column, levels: int = LEVELS) -> Column:
    """Array of (level, place) of the dyadic segments of [start, end); empty where end <= start."""

    def at(level: Column) -> Column:
        first, _ = _shifted(start, level)
        _, last = _shifted(end, level)
        left = F.when((first < last) & (first % 2 == 1), first)
        right = F.when((first < last) & (last % 2 == 1), last - 1)
        return F.array(F.struct(level.alias("level"), left.alias("place")), F.struct(level.alias("level"), right.alias("place")))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))
    return F.filter(every, lambda s: s["place"].isNotNull())


def ancestors(point: Column, levels: int = LEVELS) -> Column:
    """Array of (level, place) of the segments that hold a point, one per level."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(levels)), lambda level: F.struct(level.alias("level"), _shifted(point, level)[1].alias("place"))
    )


def join_points(intervals: DataFrame, points: DataFrame, start: str, end: str, at: str, levels: int = LEVELS) -> DataFrame:
    """Every row of ``points`` with every row of ``intervals`` that has start <= at < end.

    All three are whole numbers from 0 to 2**levels, ``at`` below it; rows with a null or an empty interval have no partner. Parts
    of an interval outside of that range meet no point.
    """
    cut, probes = _cut(intervals, start, end, levels), _probes(points, at, levels)
    return cut.join(probes, "_segment").drop("_segment")


def count_points(
    intervals: DataFrame, points: DataFrame, start: str, end: str, at: str, by: Sequence[str], value: Column, name: str, levels: int = LEVELS
) -> DataFrame:
    """``join_points`` grouped by the point's row and the intervals' columns ``by``: ``value``, a count over intervals, as ``name``.

    A point meets an interval in exactly one segment, so counts of segments add up. Intervals are counted by segment and
    different points met once, however many intervals or points are equal.
    """
    counted = _cut(intervals, start, end, levels).groupBy("_segment", *by).agg(value.alias("_value"))
    probes = _probes(points.select(at).distinct(), at, levels)
    met = counted.join(probes, "_segment").groupBy(at, *by).agg(F.sum("_value").alias(name))
    return points.join(met, at)


def _cut(intervals: DataFrame, start: str, end: str, levels: int) -> DataFrame:
    inside = intervals.where(F.col(start) < F.col(end)).withColumns(
        {"_start": F.greatest(F.col(start), F.lit(0)).cast("bigint"), "_end": F.least(F.col(end), F.lit(1 << levels)).cast("bigint")}
    )
    return inside.withColumn("_segment", F.explode(segments(F.col("_start"), F.col("_end"), levels))).drop("_start", "_end")


def _probes(points: DataFrame, at: str, levels: int) -> DataFrame:
    inside = points.where(F.col(at).between(0, (1 << levels) - 1))
    return inside.withColumn("_segment", F.explode(ancestors(F.col(at).cast("bigint"), levels)))
