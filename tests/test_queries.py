"""Every named query equals its SQL on the test tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

from wardlight.plans.oracles import ORACLES
from wardlight.plans.registry import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, db, name):
    _, found = difference(QUERIES[name](spark, sf_dir), db, ORACLES[name])
    assert found is None, found
