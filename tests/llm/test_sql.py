"""The queries that SQL can express, against their SQL."""

import pytest

from oracle_compare import compare
from tallybrook.llm.oracle import ORACLES
from tallybrook.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, name):
    assert compare(spark, data, name, QUERIES[name], ORACLES[name]) > 0
