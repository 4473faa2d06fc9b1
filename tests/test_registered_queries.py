"""Every registered query against its SQL on the smallest tables, and the driver's entry points."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from bazaarspark.checks.compare import difference, tables
from bazaarspark.checks.registry import checks

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(SMALL)


# Minutes each, for the thousands of day folders they write; what they do is tested on small tables (test_ingest,
# test_key_index, test_streaming_and_run). ALL_QUERIES=1 compares them here as well.
LONG = {"i2_ingest_rerun", "k7_staging_loads", "k10_marts_and_views"}
NAMES = sorted(n for n in checks() if n not in LONG or os.environ.get("ALL_QUERIES"))


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    assert difference(spark, con, checks()[name], SMALL) is None


def test_entry_points(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
