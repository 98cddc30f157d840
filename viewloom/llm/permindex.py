"""Nearest neighbours by a permutation index.

A vector is represented by its nearest pivots, in order of nearness. The index deals vectors into blocks of a
bounded size by a hash of their ids and is written once; a block posts each of its vectors in the inverted files of the vector's pivots,
with the pivot's place. A query reads the files of its own pivots only and adds up, for every vector it meets, what
the shared pivots take off the footrule distance of the two orders (a pivot that only one of them holds
counts as if it followed the other's last). The best share of a block is ranked again by exact cosine.

Queries are a stated set that meets all blocks. They are sent to the index in passes of a bounded number, so that vectors
stay where they are; a task merges the answers of its blocks, and the answer to a query is the best of the tasks' answers. Nothing but
pivots, a bounded sample, and a pass of queries is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.session import cut_lineage

PIVOTS, PLACES = 128, 64
BLOCK_ROWS, QUERY_ROWS = 8192, 32768
RERANKED = 0.2  # of a block
LEAST_RERANKED = 512


def usable(vector: Column) -> Column:
    """Not null, not zero, all components there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def usable_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector) of the usable rows; rows without a key take no part."""
    rows = df.where(F.col(key).isNotNull() & usable(F.col(vector)))
    return rows.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("vector"))


def choose_pivots(rows: DataFrame, pivots: int) -> np.ndarray:
    """Different directions among the 8 * ``pivots`` rows of the smallest hashes, one per row."""
    sample = rows.orderBy(F.xxhash64(F.lit(5), "key"), "key", "vector").limit(8 * pivots).collect()
    found = {}
    for r in sample:
        v = np.array(r.vector)
        v /= np.sqrt((v * v).sum())
        found.setdefault(tuple(np.round(v, 9)), v)
    return np.array(list(found.values())[:pivots])


def places(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of every vector, nearest first; ties go to the smaller pivot."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :length]


class Block:
    """The inverted files of a block; ``near`` holds the pivots of every vector, nearest first."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, near: np.ndarray, pivots: int):
        order = np.argsort(keys, kind="stable")  # ties of any rank go to the smaller key
        self.keys, self.vectors = keys[order], vectors[order]
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.length = length = near.shape[1]
        flat = near[order].reshape(-1)
        by_pivot = np.argsort(flat, kind="stable")
        self.rows = by_pivot // length
        self.gains = (length - by_pivot % length).astype(np.int64)
        self.starts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def search(self, key: int, vector: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and cosines of the k best of this block for a query."""
        n = len(self.keys)
        files = [slice(self.starts[p], self.starts[p + 1]) for p in near]
        rows = np.concatenate([self.rows[f] for f in files])
        gains = np.concatenate([np.minimum(self.gains[f], self.length - i) for i, f in enumerate(files)])
        # The footrule distance is a constant less twice the sum of these.
        closeness = np.bincount(rows, gains, n).astype(np.int64)
        wanted = max(LEAST_RERANKED, k + 1, int(np.ceil(RERANKED * n)))
        at = np.arange(n)
        if wanted < n:
            at = np.sort(np.argpartition(-(closeness * n + (n - 1 - at)), wanted)[:wanted])
        at = at[self.keys[at] != key]
        scores = (self.vectors[at] * vector).sum(axis=1) / (self.norms[at] * np.sqrt((vector * vector).sum()))
        best = np.argsort(-scores, kind="stable")[:k]
        return self.keys[at[best]], scores[best]


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), np.float64).reshape(-1, dimension)


def nearest(
    df: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS, length: int = PLACES
) -> DataFrame:
    """(query_id, rank, key, score): the k nearest rows found for every row that ``queries`` holds for.

    Nearness is the cosine in double precision; ties go to the smaller key. Rows of the query's own key take no part, and
    neither do unusable vectors. Vectors of each dimension have an index of their own and are answered among themselves, for
    there is no cosine across. With fewer other rows than k all of them are returned; an empty table
    gives an empty result. A key that stands on several rows is answered for each of its rows, together.
    """
    rows, asked = usable_vectors(df, key, vector), usable_vectors(df.where(queries), key, vector)
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    found = df.sparkSession.createDataFrame([], f"query_id bigint, {key} bigint, score double")
    for d, n in sorted((r.d, r.n) for r in sizes):
        found = found.union(_nearest(rows.where(F.size("vector") == d), asked.where(F.size("vector") == d), d, n, k, key, pivots, length))
    # Over dimensions too, for a key may stand on vectors of several.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", key, "score")


def _nearest(rows: DataFrame, asked: DataFrame, dimension: int, n: int, k: int, key: str, pivots: int, length: int) -> DataFrame:
    """(query_id, key, score) of each block's best for the queries, all of one dimension; ``n`` rows."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(choose_pivots(rows, pivots))
    blocks = -(-n // BLOCK_ROWS)
    size = min(length, len(shared.value))
    number = F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("block", number).repartition(max(2, min(blocks, 4096)), "block").sortWithinPartitions("block", "key")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), dimension)
            near = places(vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None], shared.value, size)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(near.reshape(-1), pa.int16()), size).cast(pa.list_(pa.int16()))
            columns = [batch.column(c) for c in ("block", "key", "vector")]
            yield pa.RecordBatch.from_arrays([*columns, listed], names=["block", "key", "vector", "near"])

    index = cut_lineage(dealt.mapInArrow(post, "block int, key bigint, vector array<double>, near array<smallint>"))
    passes = max(1, -(-asked.count() // QUERY_ROWS))
    turn = F.pmod(F.xxhash64(F.lit(4), "key", "vector"), F.lit(passes))
    found = spark.createDataFrame([], f"query_id bigint, {key} bigint, score double")
    for nth in range(passes):
        # A pass holds about QUERY_ROWS queries.
        rows_of_pass = asked.where(turn == nth).orderBy("key").toArrow()
        if rows_of_pass.num_rows:
            found = found.union(cut_lineage(_answers(index, rows_of_pass, shared, dimension, k, key)))
    return found


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, from batches that are sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a < b and held and held[0].column("block")[0].as_py() != numbers[a]:
                yield pa.Table.from_batches(held)
                held = []
            if a < b:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _answers(index: DataFrame, queries: pa.Table, pivots, dimension: int, k: int, key: str) -> DataFrame:
    """(query_id, key, score): for every query of a pass the best of every task's blocks."""
    keys = queries.column("key").to_numpy()
    vectors = _matrix(queries.column("vector"), dimension)
    near = places(vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None], pivots.value, pivots.value.shape[0])
    asked = index.sparkSession.sparkContext.broadcast((keys, vectors, near))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, points, orders = asked.value
        best_keys: list[np.ndarray] = [np.zeros(0, np.int64)] * len(own)
        best_scores: list[np.ndarray] = [np.zeros(0)] * len(own)
        for table in whole_blocks(batches):
            rows = table.num_rows
            posted = np.asarray(table.column("near").combine_chunks().flatten(), np.int64).reshape(rows, -1)
            block = Block(table.column("key").to_numpy(), _matrix(table.column("vector"), dimension), posted, orders.shape[1])
            for i, (q, v, p) in enumerate(zip(own, points, orders[:, : block.length], strict=True)):
                found, scores = block.search(q, v, p, k)
                found, scores = np.concatenate((best_keys[i], found)), np.concatenate((best_scores[i], scores))
                kept = np.lexsort((found, -scores))[:k]
                best_keys[i], best_scores[i] = found[kept], scores[kept]
        counts = [len(x) for x in best_keys]
        if sum(counts):
            columns = [pa.array(np.repeat(own, counts)), pa.array(np.concatenate(best_keys)), pa.array(np.concatenate(best_scores))]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", key, "score"])

    return index.mapInArrow(search, f"query_id bigint, {key} bigint, score double")
