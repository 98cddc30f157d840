"""Item similarity and viewing reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.functions.predicates import valid_ids
from viewloom.functions.scalars import completion_bin
from viewloom.operators import cooccurrence as co
from viewloom.operators.counts import series_progress, share_histogram
from viewloom.session import cut_lineage


def as_ids(df: DataFrame, *columns: str, max_length: int | None = None) -> DataFrame:
    """Keep rows whose ids are numbers that fit, as bigint."""
    kept = df.where(valid_ids(*[F.col(c) for c in columns], max_length=max_length))
    for c in columns:
        kept = kept.withColumn(c, F.col(c).cast("string").try_cast("bigint"))
    return kept.dropna(subset=list(columns))


def item_similarity(ratings: DataFrame, virtual_count: float = 10.0, prior: float = 0.0) -> DataFrame:
    """Correlation, shrunk correlation, cosine and Jaccard of all co-rated item pairs."""
    # Written once: the counts per item, the counts per user and both sides of the pairs read it.
    rated = cut_lineage(co.unique_ratings(ratings))
    return co.similarities(co.pair_moments(rated), virtual_count, prior)


def series_completion(plays: DataFrame, episodes: DataFrame) -> DataFrame:
    """(user_id, series_id, total, watched, ratio)."""
    return series_progress(as_ids(plays, "user_id", "content_id"), episodes)


def completion_histogram(completion: DataFrame) -> DataFrame:
    """(bin, n, total, share) of the completion ratios."""
    return share_histogram(completion, completion_bin(F.col("ratio")))
