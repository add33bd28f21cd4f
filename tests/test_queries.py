"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare
from tallybrook.plans.catalog import QUERIES
from tallybrook.plans.oracle import ORACLES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, data, name):
    assert compare(spark, data, name, QUERIES[name], ORACLES[name]) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["t", "edits", "bot_edits", "new_pages", "editors"]
    assert df.count() > 0
