"""The values FIXTURES.md records for sf0.01 (seen equal in Spark and DuckDB)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from tremor.functions import alert_level
from tremor.operators import analytics, grid, merge
from tremor.sources.fixture import fixture_feeds, load_catalog


@pytest.fixture(scope="module")
def catalog(spark):
    return load_catalog(spark, SF_CHECK)


def test_rows_and_region(catalog):
    assert analytics.catalog_count(catalog).first()["count"] == 10_000
    assert {r["region"]: r["count"] for r in analytics.region_counts(catalog).collect()}["Pakistan"] == 1_886


def test_magnitude_ranges(catalog):
    got = {r["mag_range"]: r["count"] for r in analytics.mag_range_counts(catalog).collect()}
    assert got == {"Minor": 2_084, "Light": 2_085, "Moderate": 2_083, "Strong": 2_187, "Major": 1_561}


def test_alert_levels(catalog):
    got = {r[0]: r[1] for r in catalog.groupBy(alert_level(F.col("mag"))).count().collect()}
    assert got == {"CRITICAL": 3_541, "HIGH": 1_042, "MEDIUM": 1_041, "LOW": 4_376}


def test_regional_stats(catalog):
    r = analytics.regional_stats(catalog).first()
    assert (r["total"], round(r["avg_mag"], 1), r["max_mag"], r["min_mag"]) == (1_886, 4.6, 9.4, 0.0)


def test_hotspot_cells(catalog):
    cells = grid.hotspots(catalog, sort=False)
    assert cells.count() == 498
    got = {r["risk_level"]: r["count"] for r in cells.groupBy("risk_level").count().collect()}
    assert got == {"CRITICAL": 83, "HIGH": 65, "MEDIUM": 77, "LOW": 273}


def test_merged_catalog(spark):
    merged = merge.merge_feeds(list(fixture_feeds(spark, SF_CHECK)), keep_feed=True)
    assert merged.count() == 7_398
    assert {r["region"]: r["count"] for r in merged.groupBy("region").count().collect()} == {
        "Pakistan": 1_462, "Global": 5_936,
    }
    assert {r["feed"]: r["count"] for r in merged.groupBy("feed").count().collect()} == {0: 7_292, 1: 106}


def test_summary(catalog):
    r = analytics.summary(catalog).first()
    assert tuple(r) == (10_000, 1_886, 3_541, 1_042, 4.7, 9.4)
