"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once and counted by length. Sums over all longer lengths then answer totals,
quantiles and totals after truncation for every context limit, without reading a text again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths are summed in ranges of so many first, so that no window holds all of them.
RANGE = 1024
MAX_VOCABULARY_BYTES = 64 << 20

_encodings: dict = {}


def _encoding(vocabulary: bytes, pattern: str):
    """The encoder of a vocabulary file, made once per process."""
    import tiktoken

    key = (hashlib.sha256(vocabulary).digest(), pattern)
    if key not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        _encodings[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def with_token_count(docs: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of every whole text; a null or empty text has none.

    The vocabulary, a file of the driver, is broadcast; its size is checked. An existing column ``out`` is replaced.
    """
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to be sent to every task")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoding(shared.value, pattern).encode_ordinary
        for column in batches:
            yield pa.array([len(encode(x.as_py())) if x.is_valid else 0 for x in column], pa.int64())

    return docs.withColumn(out, F.arrow_udf(count, "bigint").asNondeterministic()(F.col(text)))


def length_histogram(counted: DataFrame, by: Sequence[str] = (), length: str = "n_tokens") -> DataFrame:
    """(by..., n_tokens, documents): counts combine before the shuffle, so no group is too large."""
    return counted.groupBy(*by, F.col(length).alias("n_tokens")).agg(F.count(F.lit(1)).alias("documents"))


def with_suffix_sums(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The histogram with, for every length:

    tokens: of documents of this length; documents_longer and tokens_longer: of all longer ones;
    truncated_tokens: all tokens if texts were cut to this length; share: of documents not longer.
    """
    rows = histogram.withColumn("tokens", F.col("n_tokens") * F.col("documents")).withColumn("_range", F.floor(F.col("n_tokens") / RANGE))
    ranges = rows.groupBy(*by, "_range").agg(F.sum("documents").alias("_d"), F.sum("tokens").alias("_t"))
    keys = [F.lit(0), *by]
    above = Window.partitionBy(*keys).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*keys)
    ranges = ranges.select(
        *[F.col(c).alias(f"_b_{c}") for c in by],
        F.col("_range").alias("_r"),
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("_d", "_t")],
        *[F.sum(c).over(every).alias(f"{c}_all") for c in ("_d", "_t")],
    )
    same = rows["_range"] == ranges["_r"]
    for c in by:
        same = same & rows[c].eqNullSafe(ranges[f"_b_{c}"])
    longer = Window.partitionBy(*by, "_range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(ranges, same)
    summed = joined.withColumns(
        {
            "documents_longer": F.col("_d_above") + F.coalesce(F.sum("documents").over(longer), F.lit(0)),
            "tokens_longer": F.col("_t_above") + F.coalesce(F.sum("tokens").over(longer), F.lit(0)),
        }
    )
    return summed.select(
        *by,
        "n_tokens",
        "documents",
        "tokens",
        "documents_longer",
        "tokens_longer",
        (F.col("_t_all") - F.col("tokens_longer") + F.col("n_tokens") * F.col("documents_longer")).alias("truncated_tokens"),
        ((F.col("_d_all") - F.col("documents_longer")) / F.col("_d_all")).alias("share"),
    )


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context, tokens, documents_cut) for any limits of at least 0, in one pass over the histogram."""
    asked = [int(x) for x in limits]
    columns = []
    for i, x in enumerate(asked):
        kept = F.sum(F.least(F.col("n_tokens"), F.lit(x)) * F.col("documents"))
        cut = F.sum(F.when(F.col("n_tokens") > x, F.col("documents")).otherwise(0))
        columns.append(F.struct(F.lit(x).cast("bigint").alias("context"), F.coalesce(kept, F.lit(0)).alias("tokens"), F.coalesce(cut, F.lit(0)).alias("documents_cut")).alias(f"c{i}"))
    row = sums.agg(*columns)
    return row.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(asked))])).alias("c")).select("c.*")


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least this share of the documents doesn't exceed."""
    return sums.agg(*[F.min(F.when(F.col("share") >= s, F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)]).select(
        F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)])).alias("q")
    ).select("q.*")
