"""Queries that SQL can express equal it on the whole tables."""

import pytest

from tests import oracle
from weir.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, sf_dir, name):
    assert oracle.assert_same(QUERIES[name](spark, sf_dir), ORACLE_SQL[name], sf_dir) > 0
