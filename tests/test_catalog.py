"""Every registered query against its SQL, and the entry points."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from tidewell.catalog.expected_sql import EXPECTED
from tidewell.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, small, con, name):
    assert differences(entry_points.queries()[name](spark, small), con, entry_points.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(entry_points.queries()) and set(EXPECTED) <= set(entry_points.oracle_sql())


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["stt", "edt", "cur_date"] and df.count() > 0
