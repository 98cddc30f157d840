"""Factor model on play counts, used to re-rank what each user has already played."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.operators.ranking import top_k
from viewloom.session import cut_lineage, remove_written, shuffles_removed, written_tables

# Ratings up to which 5 blocks do, and the most that a block holds on average beyond that.
FEW_RATINGS = 2_000_000
BLOCK_RATINGS = 25_000_000
#: The most that a task of training holds on average: some 40 bytes each while a block is built, and a factor of 84 bytes for each at worst.
TASK_RATINGS = 10_000_000
#: Half iterations shuffle the factors anew; after so many iterations what they shuffled is removed.
KEPT_ITERATIONS = 1


def blocks_for(ratings: int) -> int:
    """Blocks of the solver for so many ratings; they follow the data and never the cluster, for scores depend on them.

    A half iteration has as many tasks as blocks, and sends a factor to every block that needs it, so blocks are no more than
    tasks need. Beyond 5 they are 12 or its doubles, which deal evenly over most numbers of cores.
    """
    blocks = 5 if ratings <= FEW_RATINGS else 12
    while ratings > blocks * BLOCK_RATINGS:
        blocks *= 2
    return blocks


def training_blocks(ratings: int) -> int:
    """``blocks_for`` as long as a task holds no more than ``TASK_RATINGS``, else its doubles.

    An executor builds as many blocks at a time as it has cores, so blocks have to fit its memory by that number.
    """
    blocks = blocks_for(ratings)
    while ratings > blocks * TASK_RATINGS:
        blocks *= 2
    return blocks


def dense_index(ids: DataFrame, column: str, index: str, buckets: int = 1024) -> DataFrame:
    """(column, index): consecutive numbers from 0 for the distinct ids.

    Ids are numbered within hash buckets and shifted by the sizes of the buckets before, so no
    task sees more than one bucket, and a recomputed task gives the same numbers. The ids are written once.
    """
    distinct = ids.select(column).distinct()
    bucketed = cut_lineage(distinct.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    # At most ``buckets`` rows, whatever the data holds.
    return bucketed.withColumn("_nth", nth).join(F.broadcast(shifts), "_bucket").select(
        column, (F.col("_shift") + F.col("_nth") - 1).cast("int").alias(index)
    )


def with_int_ids(counts: DataFrame) -> DataFrame:
    """Add the int ids the solver needs, numbered densely, so that no id changes another's scores by its size."""
    users = dense_index(counts, "user_id", "_user")
    items = dense_index(counts, "item_id", "_item")
    return cut_lineage(counts.join(items, "item_id").join(users, "user_id"))


def check_blocks(rated: DataFrame, blocks: int, most: int) -> None:
    """An error if a block holds more than ``most`` ratings, before any executor is lost to it.

    A block holds the ratings of whole users or items, so the largest is at least the most rated one and at least the average.
    """
    total = rated.count()
    for column in ("_user", "_item"):
        with shuffles_removed(rated.sparkSession):
            row = rated.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
        largest = max(row[0] or 0, -(-total // blocks))
        if (row[0] or 0) > most:
            raise ValueError(f"one {column[1:]} has {row[0]} ratings, more than the {most} that a task may hold")
        if largest > most:
            raise ValueError(f"a block would hold {largest} ratings, more than {most}: use {-(-total // most)} blocks at least")


def fit(
    rated: DataFrame,
    rank: int = 15,
    iterations: int = 10,
    regularization: float = 1.0,
    blocks: int | None = None,
    seed: int = 42,
    block_ratings: int = 100_000_000,
) -> ALSModel:
    """Train on user and item numbers, in ``training_blocks`` blocks unless ``blocks`` says how many.

    A task holds all ratings of its block, about 16 bytes each, and the factors they meet. ``block_ratings`` bounds
    them: 100 million take about 1.6 GB. Beyond it training is an error. Blocks lie on disk between their uses, so that an executor's
    memory is left to the tasks, whose arrays Spark doesn't count. Every iteration writes the factors of the items to the
    checkpoint folder, after which Spark removes the factors that were shuffled before.
    """
    if blocks is None:
        blocks = training_blocks(rated.count())
    check_blocks(rated, blocks, block_ratings)
    solver = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=regularization,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        implicitPrefs=False,
        userCol="_user",
        itemCol="_item",
        ratingCol="_rating",
        coldStartStrategy="drop",
        checkpointInterval=KEPT_ITERATIONS,
        seed=seed,
        intermediateStorageLevel="DISK_ONLY",
        finalStorageLevel="DISK_ONLY",
    )
    return solver.fit(rated.select("_user", "_item", F.col("plays").cast("float").alias("_rating")))


def factor_products(model: ALSModel, rated: DataFrame) -> DataFrame:
    """``rated`` with ``product``: the scalar product of the user's and the item's factors, which a prediction is.

    Factors of the items come first: rows that ``model.transform`` made lie by item already.
    """
    users = model.userFactors.select(F.col("id").alias("_user"), F.col("features").alias("_u"))
    items = model.itemFactors.select(F.col("id").alias("_item"), F.col("features").alias("_i"))
    terms = F.zip_with("_u", "_i", lambda a, b: a.cast("double") * b.cast("double"))
    product = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
    return rated.join(items, "_item").join(users, "_user").withColumn("product", product).drop("_u", "_i")


def played_scores(model: ALSModel, rated: DataFrame) -> DataFrame:
    """(_user, user_id, item_id, score): what the model predicts for the pairs of ``rated``, dealt by user.

    As ``model.transform`` on pairs that were trained on, but pairs meet the factors of their item first, so that what a user's
    list is made of lies together after the second join and moves no further.
    """
    users = model.userFactors.select(F.col("id").alias("_user"), F.col("features").alias("_u"))
    items = model.itemFactors.select(F.col("id").alias("_item"), F.col("features").alias("_i"))
    terms: list[Column] = [F.col("_u")[n] * F.col("_i")[n] for n in range(model.rank)]
    joined = rated.select("_user", "_item", "user_id", "item_id").join(items, "_item").join(users, "_user")
    scored = joined.select("_user", "user_id", "item_id", reduce(add, terms).alias("score"))
    return scored.where(~F.isnan("score"))


def rerank_played(counts: DataFrame, k: int, **settings) -> DataFrame:
    """(user_id, item_id, score, rank): the user's own items by predicted score, best k.

    ``counts`` has user_id, item_id, plays. Only observed pairs are scored.
    """
    before = written_tables()
    rated = with_int_ids(cut_lineage(counts.select("user_id", "item_id", "plays")))
    # The counts without numbers and the numbers alone are in it.
    remove_written(counts.sparkSession, before, rated)
    model = fit(rated, **settings)
    return top_k(played_scores(model, rated), ["_user"], [F.desc("score"), F.asc("item_id")], k).drop("_user")
