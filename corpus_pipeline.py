"""The corpus pipeline: five stages from raw documents to a mixed training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. A stage works on all that its predecessor kept. Null, empty and repeated rows are handled as the
operators state; a table without rows gives a table without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import bagminhash, decontaminate, langid, linecrf, linededup, mixing
from viewloom.llm.frames import TEXT, own, packed
from viewloom.session import cut_lineage, remove_written, written_tables

ORDER = "_order"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, learnt from two thirds of the labels, takes for good ones."""
    held = langid.held_out(F.col("doc_id"), 3, 1)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held).select("doc_id", "quality")
    model = linecrf.train(docs.where(~held), labels)
    rows = packed(docs, "text")
    kept = linecrf.score(rows, model, text=TEXT).where("predicted = 1")
    return kept.select(*[own(c, "text").alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in ten documents or more. A null text stays null.

    Documents of which such lines are half or more are copies. Of every group of copies with the same such lines, the first by
    doc_id keeps its whole text, so that near_dedup has it to choose from.
    """
    rows = packed(docs, "text").withColumn(ORDER, own("doc_id", "text"))
    kept = linededup.drop_common_lines(rows, ORDER, text=TEXT, min_docs=10, min_length=1)
    changed = {
        "text": F.when(F.col(TEXT).isNull(), F.lit(None).cast("string")).otherwise(F.col("kept_text")),
        "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("bigint")).otherwise(own("n_chars", "text")),
    }
    return kept.select(*[changed.get(c, own(c, "text")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest id."""
    return bagminhash.one_of_each(docs, size=5, similarity=0.8, bands=21, rows=6)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=13)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, numbered by ``copy``."""
    return mixing.mixed(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: A trained model and random signatures have no SQL form; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each on the written result of the one before; what a stage wrote on its way goes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        mark = written_tables()
        docs = cut_lineage(stage(spark, docs, sf_dir))
        remove_written(spark, mark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
