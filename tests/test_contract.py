"""Every registered query gives the same rows as its SQL, on the smallest tables."""

import pytest
from compare import connect, difference

from suite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    diff, _ = difference(spark, con, SF, QUERIES[name], ORACLES.get(name))
    assert diff is None


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert driver.queries().keys() >= driver.oracle_sql().keys()
