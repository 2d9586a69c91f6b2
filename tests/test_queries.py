"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"

OWN = [query.__name__ for query in entry._QUERIES]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(OWN) == entry._own_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 10
