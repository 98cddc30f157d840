"""Gates, replacement and writing of ranked lists.

A published list is at most as long as the k it was ranked with, so windows per list key are
bounded. Lists live in one table partitioned by run date; a run replaces its own partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.functions.scalars import split_ids
from viewloom.session import cut_lineage


def longer_than(lists: DataFrame, more_than: int | Column, key: str = "list_key") -> DataFrame:
    """Lists with more than ``more_than`` rows."""
    counted = lists.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return counted.where(F.col("_n") > more_than).drop("_n")


def one_list_per_key(lists: DataFrame, by: Sequence[str], key: str = "list_key") -> DataFrame:
    """Where several groups made a list for the same key, keep the group that is last in ``by``."""
    group = F.struct(*by)
    last = F.max(group).over(Window.partitionBy(key))
    return lists.withColumn("_last", last).where(F.col("_last") == group).drop("_last")


def replace_unless_shorter(previous: DataFrame, new: DataFrame, key: str = "list_key") -> DataFrame:
    """New lists where they are at least as long as the stored ones, the stored ones elsewhere."""
    both = new.withColumn("_new", F.lit(1)).unionByName(previous.withColumn("_new", F.lit(0)))
    w = Window.partitionBy(key)
    n_new = F.sum("_new").over(w)
    n_old = F.sum(1 - F.col("_new")).over(w)
    judged = both.withColumn("_take", F.when((n_new > 0) & (n_new >= n_old), 1).otherwise(0))
    return judged.where(F.col("_take") == F.col("_new")).drop("_take", "_new")


def episode_owners(series: DataFrame) -> DataFrame:
    """(content_id, owners): the series id and the episodes of all its ``sort_index`` lists, one row per series."""
    episodes = F.transform(split_ids(F.col("sort_index")), lambda x: x.try_cast("bigint"))
    listed = series.where(F.col("sort_index").isNotNull()).select("content_id", episodes.alias("episodes"))
    # A list stands for a few rows of one series, not for a share of the data.
    together = listed.groupBy("content_id").agg(F.sort_array(F.collect_set("episodes")).alias("lists"))
    owners = F.array_compact(F.array_union(F.array(F.col("content_id")), F.flatten("lists")))
    return together.select("content_id", owners.alias("owners"))


def to_episodes(lists: DataFrame, series: DataFrame) -> DataFrame:
    """Every series' rows under the series id and under each of its episodes (column ``owner_id``).

    ``series`` has content_id and its episodes in ``sort_index``; lists of other ids are dropped.
    """
    owned = lists.join(episode_owners(series), "content_id")
    return owned.withColumn("owner_id", F.explode("owners")).drop("owners")


def write_lists(lists: DataFrame, path: str, run_date: dt.date | str) -> None:
    """Replace the lists of one run date; other dates stay."""
    dated = lists.withColumn("run_date", F.lit(str(run_date)).cast("date"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def read_lists(spark: SparkSession, path: str, run_date: dt.date | str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("run_date") == F.lit(str(run_date)).cast("date")).drop("run_date")


def write_text(df: DataFrame, path: str) -> None:
    """Comma text files; the folder is replaced as a whole."""
    df.write.mode("overwrite").csv(path)


def replicate(df: DataFrame, writers: Sequence[Callable[[DataFrame], None]]) -> None:
    """Hand the same rows to several targets, computed once."""
    fixed = cut_lineage(df)
    for write in writers:
        write(fixed)


def each_partition(lists: DataFrame, writer: Callable[[Iterable[Row]], None], key: str = "list_key") -> None:
    """Call ``writer`` with the rows of whole lists in rank order, for stores Spark cannot write to."""
    lists.repartition(key).sortWithinPartitions(key, "rank").foreachPartition(writer)
