"""Every query of the catalogue against its SQL twin on the smallest tables."""

import pytest

from conftest import SAMPLE
from oracle import connect, differences
from sensorwatch.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def duck():
    return connect(SAMPLE)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SAMPLE), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SAMPLE).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
