"""Every registered query against its SQL, at the smallest scale (or ORACLE_SF_DIR)."""

import os

import pytest

import __spark_entry__ as registered
from oracle import connect, difference
from registry.checked import checked_queries
from registry.expected import expected_sql

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_expected_result():
    assert checked_queries().keys() == expected_sql().keys()
    assert checked_queries().keys() <= registered.queries().keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", list(checked_queries()))
def test_query(spark, duck, name):
    assert difference(checked_queries()[name](spark, SF_DIR), duck, expected_sql()[name]) is None


def test_entry(spark):
    assert registered.entry(spark).columns == ["location_name", "date_value", "hours_recorded", "avg_temp"]
