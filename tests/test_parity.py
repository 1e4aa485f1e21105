"""Every registered query against its SQL counterpart."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from parity import compare, connect

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert {q for q in QUERIES if not q.startswith("op") and q != "pipeline"} <= set(SQL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_parity(name, spark, duck):
    assert compare(duck, spark, QUERIES[name], SQL[name], SF_DIR) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
