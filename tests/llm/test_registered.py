"""The registered queries of the language operators against their SQL."""

import oracle
import pytest
from conftest import MEDIUM

import corpus_pipeline
from pixelweave import llm

SQL = llm.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(MEDIUM)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    assert oracle.differences(llm.queries()[name](spark, MEDIUM), tables, SQL[name]) is None


def test_names():
    names = sorted(llm.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(SQL) < set(names)
    assert corpus_pipeline.queries() == {"pipeline": corpus_pipeline.run}

