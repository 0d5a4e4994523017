"""The corpus queries that SQL can say, against their SQL."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

from tallyhouse.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert entry.oracle_sql()[name] == ORACLES[name]
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []
