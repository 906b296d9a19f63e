"""Every registered query equals its DuckDB SQL (exact values) on the smallest tables.

The driver runs the same comparison at sf0.01; ``tests/oracle_harness.py`` does
it from the command line for any folder.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tremor.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck_connection


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_catalog_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, key):
    ok, msg = compare(spark, key, SF_SMALL, duck)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["lat_grid", "lon_grid", "count", "risk_level"]
    assert df.count() > 0
