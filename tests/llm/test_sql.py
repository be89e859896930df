"""The registered queries of the subpackage equal their SQL on the test tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

from wardlight.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, db, name):
    _, found = difference(QUERIES[name](spark, sf_dir), db, ORACLES[name])
    assert found is None, found
