"""Tables that are written in buckets of a key, so that joins and counts by the key need no shuffle.

A log is dealt into buckets once, when it is written. Every later join with a lookup of the same buckets reads bucket by bucket.
Bucketed tables are tables of the session's catalogue; their files lie where the caller says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a bucket: one task sorts them when they are written and counts them when they are read.
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = 8, bucket_rows: int = BUCKET_ROWS) -> int:
    """How many buckets ``rows`` rows need: ``least``, doubled until none has more than ``bucket_rows`` on average.

    So tables of different sizes have bucket counts that are multiples of each other.
    """
    buckets = least
    while buckets * bucket_rows < rows:
        buckets *= 2
    return buckets


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as the table ``table`` in ``path``, in ``buckets`` buckets of the columns ``by``, and return the table.

    One file per bucket: rows are dealt by the buckets' own hash before they are written. Tables that are joined need the
    same number of buckets, or a multiple; a key that holds a large share of the rows fills one bucket, so bucket counts per key,
    not raw rows, where keys are that uneven.
    """
    dealt = df.repartition(buckets, *[F.col(c) for c in by])
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *by)
    if sort or by:
        writer = writer.sortBy(*(sort or by))
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Take the table out of the catalogue; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
