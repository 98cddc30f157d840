"""Every corpus query: against its SQL, on edge cases and on empty tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect
from tests.llm.conftest import FOLDER, write_tables
from viewloom.llm.queries import ORACLES, QUERIES

PER_DOCUMENT = sorted(set(QUERIES) - {"op2_token_counts", "op3_nearest_vectors", "op12_embedding_whitening"})


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    _, _, _, problems = compare(spark, connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER)
    assert problems == []


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_edge_cases_give_a_row_per_document(spark, edges, tmp_path, name):
    folder = write_tables(spark, str(tmp_path), edges)
    rows = QUERIES[name](spark, folder).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edges.collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_edge_cases_against_sql(spark, edges, tmp_path, name):
    import duckdb

    folder = write_tables(spark, str(tmp_path), edges)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    _, _, _, problems = compare(spark, con, name, QUERIES[name], ORACLES[name], folder)
    assert problems == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, documents, tmp_path, name):
    documents.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for table in ("labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op4_secret_scan", "op5_pseudonyms", "op7_source_mix"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
