"""Every registered query against its SQL oracle in DuckDB."""

import os

import pytest

from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], con) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= entry.queries().keys() and entry.oracle_sql().keys() <= entry.queries().keys()
