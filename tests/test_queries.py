"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from checks.catalog import CHECKS
from checks.compare_results import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_sql(spark, con, name):
    ok, why = compare(spark, con, CHECKS[name], SF)
    assert ok, why


def test_entry_and_registry(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    rows = entry_point.entry(spark)
    assert rows.columns == [
        "service_type", "resource_id", "field_name", "old_value", "new_value", "changed_by", "account_id", "region",
    ]
    assert rows.count() > 0
