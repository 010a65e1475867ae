"""Every registered query against its SQL twin, over whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from feedloom.queries import catalog

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, tables, name):
    assert compare(spark, tables, SF_DIR, driver.queries()[name], driver.oracle_sql()[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["record_number", "error_type", "error_message"] and df.count() > 0
