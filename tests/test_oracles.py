"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

from tallyhouse.workload.oracles import ORACLES
from tallyhouse.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    assert differences(df, connection, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
