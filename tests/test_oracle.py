"""Every named query equals plain SQL on the base tables."""

import pytest

import __spark_entry__
from tests import oracle
from weir.plans import catalog, oracles

QUERIES = catalog.QUERIES
SQL = oracles.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    assert oracle.assert_same(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) > 0


def test_entry(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["topic", "day", "n_messages", "n_new"]
    assert rows.count() > 0
