"""Exact draws from groups of any size.

``numbered`` gives the rows of a table dense positions from 0 in a stated order, so every group of its first sort
columns is an interval of positions. A list is then drawn by choosing positions: ``drawn_positions`` is a
uniform set of m of the numbers below n, and a join by position fetches the rows. No list is paired with its
group, a draw of k costs k rows, and a hot group's rows lie in as many partitions as its share of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.functions.scalars import draw_number
from viewloom.session import cut_lineage

AT = "_at"
_ROW_BITS = 33  # of monotonically_increasing_id, the rest is the partition


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df``, written, with column ``_at``: the row's position from 0 in the order of the columns ``order``.

    Rows are sorted in ranges, so no group is sorted by one task; a row's position is the rows of the ranges before its own
    (one number per partition) and its place in it. Rows that are equal in ``order`` follow each other in any order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(starts, "_part")
    place = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return cut_lineage(joined.withColumn(AT, F.col("_before") + place).drop("_part", "_place", "_before"))


def intervals(rows: DataFrame, keys: Sequence[str], first: str, size: str) -> DataFrame:
    """(keys..., first, size): where the rows of each group begin and how many they are."""
    return rows.groupBy(*keys).agg(F.min(AT).alias(first), F.count(F.lit(1)).alias(size))


def drawn_positions(n: Column, m: Column, seed: int | str, *ids: Column) -> Column:
    """``m`` different numbers below ``n``, every set of m equally likely; seeded by ``ids``.

    For j = n - m ... n - 1 in turn, a number up to j is drawn and taken, or j itself if the number is
    taken already. So the cost depends on m alone.
    """
    m = F.least(F.greatest(m, F.lit(0)), n).cast("bigint")
    low = (n - m).cast("bigint")
    steps = F.when(m > 0, F.sequence(low, low + m - 1)).otherwise(F.array().cast("array<bigint>"))
    draws = F.transform(steps, lambda j: F.struct(j.alias("last"), F.pmod(draw_number(seed, *ids, j - low), j + 1).alias("number")))
    none = F.array().cast("array<bigint>")

    def take(taken: Column, x: Column) -> Column:
        return F.concat(taken, F.array(F.when(F.array_contains(taken, x["number"]), x["last"]).otherwise(x["number"])))

    return F.aggregate(draws, none, take)
