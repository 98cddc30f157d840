"""Every registered query against its comparison SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    _, _, _, problems = compare(spark, con, name, QUERIES[name], ORACLES.get(name), FOLDER)
    assert problems == []


def test_every_comparison_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # The factor model has no SQL form.
    assert set(QUERIES) - set(ORACLES) == {
        "als_rerank", "als_rerank_ott", "als_list", "als_customers", "cinema_rerank"
    }


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_plan_pairs_no_rows_without_keys(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["item1", "item2", "corr", "reg_corr", "cos_sim", "jaccard"]
    assert rows.count() > 0
