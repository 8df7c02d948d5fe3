"""Every registered query against its SQL, on whole tables."""

import oracle
import pytest
from conftest import MEDIUM, SMALL

import __spark_entry__ as contract
from pixelweave import plans

QUERIES = plans.queries()
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(MEDIUM)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    assert oracle.differences(QUERIES[name](spark, MEDIUM), tables, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r["label"] for r in sorted(rows, key=lambda r: r["class_idx"])] == [
        "purchase", "click", "view", "cart", "signup",
    ]


def test_no_sql_without_query():
    assert set(SQL) <= set(QUERIES)
