"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks.registry import QUERIES
from checks.compare import difference, duck

SF_DIR = driver.SMALL


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_every_sql_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_counts_all_hours(spark):
    assert driver.entry(spark).count() == 24
