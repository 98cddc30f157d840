from __future__ import annotations

import pytest

FOLDER = "/root/testdata/sf0.001"

LONG = "x" * 200_000
#: doc_id, text, lang, source: nulls in every column, empty and very long texts, ties and repeated rows.
EDGES = [
    (1, None, "en", "a"),
    (2, "", "de", None),
    (3, "", None, "b"),
    (3, "", None, "b"),
    (None, "one two three four five six seven", "en", "a"),
    (None, None, None, None),
    (4, "\n\n \t\n", "fr", "c"),
    (5, LONG, "en", "c"),
    (6, "word " * 40_000, "en", "d"),
    (7, "token = abcdef0123456789abcdef0123456789\n" * 30, "es", "d"),
    (8, "été \U0001f600 4111111111111111 ünïcode 2001-02-28", "fr", "b"),
    (9, "the same line\nof two texts that repeat", "en", "a"),
    (10, "the same line\nof two texts that repeat", "en", "a"),
    (11, "\u0001 \u0002 \u0000 7 !!! ???", "en", "e"),
]
#: Names that results and helper columns use.
CLASHES = "size target taken copies score predicted lang_pred n_words n_hit items bag bands label key spans kept_text _row _text _class copy".split()


@pytest.fixture(scope="session")
def edges(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    return rows.withColumn("n_chars", F.length("text").cast("long")).repartition(3, "source").cache()


@pytest.fixture(scope="session")
def clashing(edges):
    from pyspark.sql import functions as F

    return edges.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHES])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def write_tables(spark, folder: str, documents) -> str:
    """A folder of tables with other documents; the rest as given."""
    documents.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder
