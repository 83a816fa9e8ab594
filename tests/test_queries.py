"""Every registered query against its SQL, on the smallest tables."""

import pytest
from checks import corpus, paths, tasks
from checks.compare import compare, duck

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


NAMES = [name for module in (corpus, tasks, paths) for name in module.QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) <= driver.queries().keys()
    assert set(NAMES) <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_entry(spark):
    assert driver.entry(spark).count() == 1000
