"""Every query with an SQL twin must give the same values; every other query must give rows."""

import os

import pytest

from flowsift.queries import REGISTRY
from oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WITH_SQL = [name for name, q in REGISTRY.items() if q.sql]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, REGISTRY[name], FOLDER) is None


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_gives_rows(spark, name):
    assert REGISTRY[name].run(spark, FOLDER).count() > 0
