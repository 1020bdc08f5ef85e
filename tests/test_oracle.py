"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from oracle import compare, connect
from tidebars.catalog import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, sf_dir, name):
    ok, message = compare(spark, con, name, registry.QUERIES[name], registry.SQL.get(name), sf_dir)
    assert ok, message


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["symbol", "timestamp", "close", "ret", "new_state", "sma_20"]
    assert df.count() > 0
