"""Every registered query against its SQL; those without SQL must give rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from loomframe.plans import CHECKS, QUERIES
from loomframe.session import drop_staged
from oracle_check import compare, connect

# models run Python and products of their own; neighbours run Python in tasks by design
OWN_PLANS = {n for n in QUERIES if n.startswith("m_")} | {"knn_classify", "knn_impute"}
UNWANTED = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"
)


def no_products_and_no_python(df) -> None:
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in text]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, name):
    inspect = None if name in OWN_PLANS else no_products_and_no_python
    ok, note, _ = compare(spark, con, name, SF_DIR, QUERIES, CHECKS, inspect)
    drop_staged(spark)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_gives_rows(spark, con, name):
    ok, note, _ = compare(spark, con, name, SF_DIR, QUERIES, CHECKS)
    assert ok, note


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
