"""Filling short lists from a pool, and lists that follow a catalogue.

A pool is one group shared by all lists, so it is never paired with them. Its ids are numbered once; a list draws
as many positions as it lacks, and as many more as it has ids that the draw may hit. So every list is a draw over
the whole pool, of any size, at a cost that depends on the length of lists alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.functions.scalars import draw_order
from viewloom.operators.columns import computed
from viewloom.operators.positions import AT, drawn_positions, intervals, numbered
from viewloom.operators.ranking import top_k
from viewloom.session import cut_lineage


@dataclass(frozen=True)
class Pool:
    """Numbered ids (group..., item, fields..., _at); one row per group and id."""

    rows: DataFrame
    item: str
    group: Sequence[str] = ()
    fields: Sequence[str] = field(default=())


def pool_of(pool: DataFrame, item: str, group: Sequence[str] = (), fields: Sequence[str] = ()) -> Pool:
    """The different ids of ``pool``, numbered; of repeated ids the row with the least fields stays."""
    ids = pool.where(F.col(item).isNotNull()).select(*group, item, *fields)
    if fields:
        ids = ids.groupBy(*group, item).agg(F.min(F.struct(*fields)).alias("_f")).select(*group, item, "_f.*")
    else:
        ids = ids.distinct()
    return Pool(numbered(ids, [*group, item]), item, tuple(group), tuple(fields))


def fill_lists(
    lists: DataFrame,
    pool: Pool,
    seat_by: Sequence[str],
    have: str,
    k: int,
    seed: int | str,
    exclude: Sequence[str] = (),
    other_ids: bool = False,
) -> DataFrame:
    """Array column ``fill``: pool rows that bring the id array ``have`` up to ``k`` entries.

    ``seat_by`` tells lists apart and isn't null. Ids in ``have`` and in the ``exclude`` columns are not used, unless ``have``
    lists ids of another kind than the pool's. The free ids are equally likely, in the order of a hash of list and id;
    a pool with fewer of them gives all. The lists are written once.
    """
    seats = [F.col(c) for c in seat_by]
    if pool.group:
        placed = lists.join(intervals(pool.rows, pool.group, "_first", "_size"), list(pool.group), "left")
    else:
        size = pool.rows.agg(F.count(F.lit(1)).alias("_size"))
        placed = lists.withColumns({"_first": F.lit(0), "_size": size.scalar()})
    lacking = F.greatest(F.lit(k) - F.size(have), F.lit(0))
    barred = F.lit(0) if other_ids else F.size(have) + F.lit(len(exclude))
    drawn = drawn_positions(F.coalesce("_size", F.lit(0)), F.when(lacking > 0, lacking + barred).otherwise(0), seed, *seats)
    placed = cut_lineage(placed.withColumn("_draws", drawn))

    each = placed.select(*seat_by, F.explode("_draws").alias("_draw"), "_first").select(*seat_by, (F.col("_first") + F.col("_draw")).alias(AT))
    shown = [pool.item, *pool.fields]
    told = pool.rows.select(AT, F.struct(*[F.col(c) for c in shown]).alias("_row"))
    turn = draw_order(seed, *seats, F.col("_row")[pool.item])
    found = each.join(told, AT).groupBy(*seat_by).agg(F.array_sort(F.collect_list(F.struct(turn.alias("turn"), "_row"))).alias("_turned"))
    joined = placed.drop("_first", "_size", "_draws").join(found, list(seat_by), "left")
    rows = F.transform("_turned", lambda x: x["_row"])
    if not other_ids:
        others = F.array(*[F.col(c) for c in exclude]).cast(lists.schema[have].dataType)
        joined = computed(joined, "_taken", F.concat(F.col(have), others))
        rows = F.filter(rows, lambda x: ~F.array_contains("_taken", x[pool.item]))
    joined = computed(joined, "fill", F.slice(rows, F.lit(1), lacking))
    none = F.array().cast(joined.schema["fill"].dataType)
    return joined.withColumn("fill", F.coalesce("fill", none)).drop("_taken", "_turned")


def unseen_of_best(played: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(user_id, rank, item_id): the first k films of the catalogue of a user's rank-1 item that the user hasn't ranked.

    The catalogue is followed in its own order. A user walks as many films as k and the ranked ones that lie in this catalogue,
    however many those are. Users whose best item is in no catalogue have no row.
    """
    films = members.groupBy("catalog_id", "content_id").agg(F.min("position").alias("position"))
    placed = numbered(films, ["catalog_id", "position", "content_id"])
    best = played.groupBy("user_id").agg(F.min_by("item_id", "rank").alias("content_id"))
    home = members.groupBy("content_id").agg(F.max("catalog_id").alias("catalog_id"))
    users = best.join(home, "content_id").select("user_id", "catalog_id")
    seen = played.select("user_id", F.col("item_id").alias("content_id")).distinct().join(users, "user_id")
    seen = cut_lineage(seen.join(placed.select("catalog_id", "content_id", AT), ["catalog_id", "content_id"]).select("user_id", AT))
    met = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("_met"))
    sized = users.join(intervals(placed, ["catalog_id"], "_first", "_size"), "catalog_id").join(met, "user_id", "left")
    steps = F.least(F.col("_size"), F.lit(k) + F.coalesce("_met", F.lit(0)))
    walk = sized.select("user_id", F.explode(F.sequence(F.col("_first"), F.col("_first") + steps - 1)).alias(AT))
    free = walk.join(seen, ["user_id", AT], "left_anti")
    listed = top_k(free, ["user_id"], [F.asc(AT)], k)
    return listed.join(placed.select(AT, F.col("content_id").alias("item_id")), AT).select("user_id", "rank", "item_id")


def expand_best(played: DataFrame, members: DataFrame, pool: Pool, k: int, seed: int | str) -> DataFrame:
    """(user_id, rank, item_id, source): ``unseen_of_best``, and the pool fills the rest up to k.

    ``played`` has user_id, item_id, rank; the ranked items of a user may be any number.
    """
    own = unseen_of_best(played, members, k)
    arrays = own.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "item_id"))).alias("_own"))
    users = played.select("user_id").distinct().join(arrays, "user_id", "left")
    none = F.array().cast("array<bigint>")
    listed = users.select("user_id", F.coalesce(F.transform("_own", lambda x: x["item_id"]), none).alias("_list"))
    filled = fill_lists(listed, pool, ["user_id"], "_list", k, seed)
    rows = F.concat(
        F.transform("_list", lambda x: F.struct(x.alias("item_id"), F.lit("catalog").alias("source"))),
        F.transform("fill", lambda x: F.struct(x[pool.item].alias("item_id"), F.lit("pool").alias("source"))),
    )
    return filled.select("user_id", F.posexplode(rows).alias("_at", "_row")).select(
        "user_id", (F.col("_at") + 1).alias("rank"), "_row.item_id", "_row.source"
    )
