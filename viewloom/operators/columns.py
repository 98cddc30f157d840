"""Control over where a costly column is evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row.

    The optimizer replaces a projected column by its expression wherever a later filter, lambda
    or projection uses it, which repeats array work many times over. It does not do so with the
    output of a generator, hence the explode of a one-element array.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
