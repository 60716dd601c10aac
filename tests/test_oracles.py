"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, SF_DIR, registry.QUERIES[name], registry.ORACLES.get(name))
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
