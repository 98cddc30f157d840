"""Recommendations among items that share attributes, without forming the pairs.

A target's list is the head of its group's order, minus the target itself and the items with
the target's own title. Whatever the target is, that head lies within the first 2k rows of the
group once every title is cut to its first k rows:

* an item beyond the k-th of its own title has k items of that title in front of it, and for a
  target of another title all of them are eligible, so it is never among the first k;
* leaving out one title removes at most k of the remaining rows, and leaving out one untitled
  target removes one row.

So a group of n items costs n rows in and 2k rows kept, instead of n * n pairs, and the result
is the one the pairs would give. The kept rows travel as one array per group to the targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.functions.scalars import draw_order
from viewloom.operators.columns import computed
from viewloom.operators.positions import AT, drawn_positions, intervals, numbered
from viewloom.operators.ranking import top_k

_TITLE = "_title"
_ORDER = "_order"

#: Drawn rows of a task, which sorts them by target.
TASK_DRAWS = 250_000


def newest_first(day: Column) -> Column:
    """Ascending sort key that puts the latest date first and unknown dates last."""
    return F.coalesce(-F.unix_date(day), F.lit(2147483647))


def _with_title(items: DataFrame, item: str, title: str | None) -> DataFrame:
    """Items without a title count as titled by their id, which no other item shares."""
    own = F.concat(F.lit("#"), F.col(item).cast("string"))
    named = own if title is None else F.coalesce(F.concat(F.lit("="), F.col(title)), own)
    return items.withColumn(_TITLE, named)


def shortlist(items: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, titled: bool) -> DataFrame:
    """The rows of every group that can be among the first k for some target."""
    ascending = [F.asc(c) for c in order]
    rows = top_k(items, [*keys, _TITLE], ascending, k, "_pos") if titled else items
    return top_k(rows, keys, ascending, 2 * k, "_pos")


def _as_arrays(listed: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """One bounded array per group, in list order."""
    row = F.struct("_pos", _TITLE, *fields)
    return listed.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias(name))


def _attach(targets: DataFrame, arrays: DataFrame, keys: Sequence[str], *names: str) -> DataFrame:
    """Join the columns ``names`` of a group to its targets; NULL keys match NULL.

    The join is an outer one so that the targets are always the side that streams: the arrays
    are broadcast when Spark finds them small, and otherwise a hot group's targets can be split.
    Targets without an array drop out with the empty lists.
    """
    side = arrays.select(*[F.col(c).alias(f"_r_{c}") for c in keys], *names)
    test = F.lit(True)
    for key in keys:
        test = test & targets[key].eqNullSafe(side[f"_r_{key}"])
    return targets.join(side, test, "left").drop(*[f"_r_{c}" for c in keys])


def _eligible(rows: Column, item: str) -> Column:
    """Rows with another id and another title than the target's."""
    return F.filter(rows, lambda x: (x[item] != F.col(item)) & (x[_TITLE] != F.col(_TITLE)))


def _with_entries(df: DataFrame, rows: Column, unique_titles: bool) -> DataFrame:
    """Column ``_entries``: the list, each title once when asked."""
    if not unique_titles:
        return computed(df, "_entries", rows)
    listed = computed(df, "_listed", rows)
    listed = computed(listed, "_titles", F.transform("_listed", lambda x: x[_TITLE]))
    first = F.filter("_listed", lambda x, i: F.array_position("_titles", x[_TITLE]) == i + 1)
    return computed(listed, "_entries", first)


def _numbered(df: DataFrame, out: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Long form of ``_entries``: one row per entry with its rank, the length of its list and its fields."""
    listed = df.select(*out, F.size("_entries").alias("rec_count"), F.posexplode("_entries").alias("_at", "_rec"))
    return listed.select(
        *out,
        (F.col("_at") + 1).alias("rank"),
        "rec_count",
        *[F.col(f"_rec.{f}").alias(f"rec_{f}") for f in fields],
    )


def recommend_by_order(
    targets: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    item: str = "content_id",
    title: str | None = "title",
    fields: Sequence[str] = (),
    unique_titles: bool = True,
) -> DataFrame:
    """The first k eligible items of the target's group, repeated titles removed without refill.

    ``order`` is a list of ascending sort keys that ends with the id.
    """
    carried = [item, *fields]
    sortable = _with_title(items, item, title).withColumn(_ORDER, F.struct(*order))
    listed = shortlist(sortable, keys, [_ORDER], k, title is not None)
    found = _attach(_with_title(targets, item, title), _as_arrays(listed, keys, carried, "_rows"), keys, "_rows")
    found = _with_entries(found, F.slice(_eligible(F.col("_rows"), item), 1, k), unique_titles)
    return _numbered(found, targets.columns, carried)


def recommend_by_draw(
    targets: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    seed: int | str,
    item: str = "content_id",
    title: str | None = "title",
    fields: Sequence[str] = (),
    unique_titles: bool = True,
) -> DataFrame:
    """k eligible items drawn at random from the target's whole group, or all of them in order where there are fewer.

    Every set of k eligible items is equally likely, whatever the size of the group. Items are numbered by group and
    title, so the items of the target's own title are an interval of its group, which the draw leaves out. An item that
    has the target's id under other titles is drawn in addition and dropped. The list is in the order of a hash of target
    and item. ``targets`` has one row per group, id and title.
    """
    carried = [item, *fields]
    titled = _with_title(items, item, title).withColumn(_ORDER, F.struct(*order)).withColumn("_print", F.md5(_TITLE))
    placed = numbered(titled.select(*keys, "_print", _TITLE, _ORDER, *carried), [*keys, "_print", _TITLE, item])

    # Targets are small until they have drawn, so their bytes tell little of the work.
    tasks = max(8, -(-targets.count() * k // TASK_DRAWS))
    found = _with_title(targets, item, title).repartition(tasks, item)
    found = _attach(found, intervals(placed, keys, "_first", "_size"), keys, "_first", "_size")
    found = _attach(found, intervals(placed, [*keys, _TITLE], "_own_first", "_own"), [*keys, _TITLE], "_own_first", "_own")
    # An id has a title or a few.
    names = placed.groupBy(*keys, item).agg(F.collect_set(_TITLE).alias("_names"))
    found = _attach(found, names, [*keys, item], "_names")
    own = F.coalesce("_own", F.lit(0))
    twins = F.coalesce(F.size(F.array_remove("_names", F.col(_TITLE))), F.lit(0))
    free = F.col("_size") - own
    found = computed(found.where("_size IS NOT NULL"), "_draws", drawn_positions(free, k + twins, seed, F.col(item)))
    there = F.coalesce(F.col("_own_first") - F.col("_first"), F.lit(0))
    each = found.select(*targets.columns, _TITLE, (free - twins >= k).alias("_full"), "_first", there.alias("_there"), own.alias("_own"), F.explode("_draws").alias("_draw"))
    at = F.col("_first") + F.col("_draw") + F.when(F.col("_draw") >= F.col("_there"), F.col("_own")).otherwise(0)
    each = each.select(*targets.columns, _TITLE, "_full", at.alias(AT))

    told = placed.select(AT, F.col(_TITLE).alias("_rec_title"), _ORDER, *[F.col(c).alias(f"rec_{c}") for c in carried])
    listed = each.join(told, AT).where(F.col(f"rec_{item}") != F.col(item)).repartition(tasks, item)
    turn = F.when(F.col("_full"), draw_order(seed, F.col(item), F.col(f"rec_{item}")))
    one = Window.partitionBy(*keys, item, _TITLE)
    listed = listed.withColumn("rank", F.row_number().over(one.orderBy(turn, _ORDER))).where(F.col("rank") <= k)
    if unique_titles:
        nth = F.row_number().over(Window.partitionBy(*keys, item, _TITLE, "_rec_title").orderBy("rank"))
        listed = listed.withColumn("_nth", nth).where("_nth = 1")
        listed = listed.withColumn("rank", F.row_number().over(one.orderBy("rank")))
    counted = listed.withColumn("rec_count", F.count(F.lit(1)).over(one).cast("int"))
    return counted.select(*targets.columns, "rank", "rec_count", *[f"rec_{c}" for c in carried])
