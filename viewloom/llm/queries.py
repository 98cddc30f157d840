"""Registered queries of the corpus operators, with comparison SQL where SQL can express them."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import bagminhash, countjoin, decontaminate, langid, linecrf, linededup, mixing, permindex, pseudonyms, secretscan, tokenalign, tokencount, whitening
from viewloom.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained model, so without SQL; tests measure its held-out accuracy."""
    held = langid.held_out(F.col("doc_id"), 4, 2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held.alias("held_out"))
    model = langid.train(docs.where(~F.col("held_out")), "text", "lang", F.col("doc_id").cast("string"))
    scored = langid.predict(docs.select("doc_id", "text", "held_out"), model)
    return scored.select("doc_id", "held_out", "lang_pred", "score")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of a public tokenizer that is installed beside the library."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding has no SQL form; tests count with the encoder itself."""
    docs = table(spark, sf_dir, "documents").select("text")
    counted = tokencount.with_token_count(docs, *vocabulary()).select("n_tokens")
    return tokencount.with_suffix_sums(cut_lineage(tokencount.length_histogram(counted)))


@query
def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An approximate search, so without SQL; tests measure its recall against brute force."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return permindex.nearest(vectors, F.pmod("vec_id", F.lit(50)) == 0, k=5)


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secretscan.scan(docs, rate=0.01)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


@query
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed permutation; tests undo it and hold its rules against a plain version.

    The key is a setting; without it a run has a random key of its own, which nobody knows.
    """
    key = spark.conf.get("spark.viewloom.pseudonyms.key", None) or secrets.token_hex(32)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pseudonyms.pseudonymise(docs, key)
    return done.select("doc_id", "text", *[f"n_{kind}" for kind in pseudonyms.KINDS])


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.drop_repeated_lines(docs, min_docs=10, min_length=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op6_line_dedup"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS listed FROM documents),
lines AS (SELECT r, unnest(listed) AS line, generate_subscripts(listed, 1) AS i FROM docs),
keyed AS (
  SELECT *, translate(
    regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT keyed.*, frequent.key IS NOT NULL AS dropped FROM keyed LEFT JOIN frequent USING (key))
SELECT docs.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM docs JOIN marked USING (r) GROUP BY docs.r, docs.doc_id
"""


@query
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixture(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op7_source_mix"] = (
    "WITH "
    + mixing.mixture_sql("documents").strip()
    + f"""
SELECT doc_id, size, source_size, target, size * (certain + CASE WHEN drawn THEN 1 ELSE 0 END) AS taken
FROM round_{mixing.SQL_ROUNDS - 1}
"""
)


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures are random, so SQL has no form of it; tests hold it against all pairs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bagminhash.near_duplicates(docs, size=5, similarity=0.8, bands=21, rows=6)
    return found.select("doc_id", "class_id", "text_id", "n_units")


@query
def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained model, so without SQL; tests measure its held-out accuracy."""
    held = langid.held_out(F.col("doc_id"), 3, 1)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~held).select("doc_id", "quality")
    model = linecrf.train(docs.where(~F.col("held_out")), labels)
    return linecrf.score(docs, model).select("doc_id", "held_out", "score", "predicted")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), size=13)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLES["op10_decontamination"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT *, least(13, len(words)) AS n, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes WHERE len(words) >= n)
),
found AS (SELECT r, places.n, i, item_id FROM places JOIN windows USING (n, win)),
hits AS (
  SELECT r, count(DISTINCT w) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS w FROM (SELECT DISTINCT r, n, i FROM found)) GROUP BY r
),
held AS (
  SELECT r, count(name) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN held USING (r)
"""


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding has no SQL form; tests align with the tokenizers themselves, token by token."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces, _ = vocabulary("piece_bpe_32k.model")
    aligned = tokenalign.align(docs, *vocabulary("byte_bpe_50k.json"), pieces)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = cut_lineage(aligned.withColumn("groups_sha256", digest).drop("groups"))
    done = tokenalign.with_link_counts(aligned, ("groups_sha256",)).withColumnRenamed("key", "doc_id")
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decomposition has no SQL form; tests hold it against the covariance's own eigenvectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


@query
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of links have no practical SQL form on whole tables; tests hold them against all pairs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return countjoin.linked_components(docs, size=4, percent=85)
