"""Every registered query against its SQL, on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as e


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(e.queries()))
def test_query_matches_sql(spark, con, small, name):
    assert oracle.compare(spark, con, small, e.queries()[name], e.oracle_sql().get(name)) == ""


def test_sql_belongs_to_queries():
    assert set(e.oracle_sql()) <= set(e.queries())


def test_flagship(spark):
    df = e.entry(spark)
    assert df.columns == ["year", "total_revenue"]
    assert df.count() > 0
