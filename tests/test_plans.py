"""Physical-plan checks: the plans we want at scale, not just right answers."""

from __future__ import annotations

import contextlib
import io

import pytest

from tests.conftest import SF_SMALL
from tremor.operators import analytics, grid, merge, views
from tremor.plans.registry import QUERIES
from tremor.sinks import write_catalog
from tremor.sources.fixture import fixture_feeds, load_catalog

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
EAGER = {"csv_roundtrip", "catalog_roundtrip", "stream_watch_alerts", "stream_critical_alerts"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in EAGER))
def test_no_python_in_any_query(spark, key):
    text = plan(QUERIES[key](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES), key
    assert "Scan " in text, key


def test_aggregates_combine_map_side(spark, catalog_small):
    for df in (analytics.mag_range_counts(catalog_small), analytics.region_counts(catalog_small),
               grid.hotspots(catalog_small), analytics.summary(catalog_small)):
        text = plan(df)
        assert "partial_count" in text, text


def test_top_k_is_take_ordered(spark, catalog_small):
    for df in (analytics.top_places(catalog_small), grid.hotspots_top(catalog_small),
               views.recent_events(catalog_small), grid.hotspots_preview(catalog_small, 10)):
        assert "TakeOrderedAndProject" in plan(df)


def test_keep_first_dedupe_trims_before_shuffle(spark):
    text = plan(merge.merge_feeds(list(fixture_feeds(spark, SF_SMALL))))
    tree = text.split("\n\n", 1)[0].splitlines()
    exchange = next(i for i, line in enumerate(tree) if "Exchange" in line)
    # a WindowGroupLimit below the Exchange in the tree runs map-side, before the shuffle
    assert any("WindowGroupLimit" in line for line in tree[exchange + 1:]), "\n".join(tree)
    assert "row_number(), 1, Partial" in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(analytics.top_places(load_catalog(spark, SF_SMALL)))
    read_schema = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert read_schema and all("props" not in s and "value" not in s and "event_type" not in s for s in read_schema)


def test_region_filter_prunes_partitions_and_pushes_down(spark, tmp_dir):
    cat = load_catalog(spark, SF_SMALL)
    laid_out = f"{tmp_dir}/by_region"
    write_catalog(cat, laid_out)
    text = plan(analytics.regional_stats(spark.read.parquet(laid_out)))
    assert "PartitionFilters: [isnotnull(region" in text and "Pakistan" in text

    flat = f"{tmp_dir}/flat"
    write_catalog(cat, flat, partition_by=())
    text = plan(analytics.regional_stats(spark.read.parquet(flat)))
    assert "PushedFilters: [IsNotNull(region), EqualTo(region,Pakistan)]" in text


def test_stream_plans_are_shuffle_free(spark, tmp_dir):
    from tremor.sinks import write_lines
    from tremor.sources.fixture import load_catalog
    from tremor.streaming import alerts_from_lines, critical_alerts, line_stream, watch_alerts

    write_lines(load_catalog(spark, SF_SMALL), f"{tmp_dir}/lines")
    alerts = alerts_from_lines(line_stream(spark, f"{tmp_dir}/lines"))
    for df in (watch_alerts(alerts), critical_alerts(alerts)):
        assert df.isStreaming
        text = plan(df)
        assert "Exchange" not in text and not any(node in text for node in PYTHON_NODES), text


def test_pushdown_survives_normalization(spark, tmp_dir):
    import datetime as dt

    from tremor.sources import feed_slice, read_catalog

    write_catalog(load_catalog(spark, SF_SMALL), f"{tmp_dir}/flat", partition_by=())
    cat = read_catalog(spark, f"{tmp_dir}/flat")
    assert "PushedFilters: [IsNotNull(region), EqualTo(region,Pakistan)]" in plan(analytics.regional_stats(cat))
    text = plan(feed_slice(cat, dt.date(2024, 1, 8), dt.date(2024, 1, 15), 2.5))
    assert "GreaterThanOrEqual(time,2024-01-08T00:00)" in text and "LessThanOrEqual(time,2024-01-15T00:00)" in text
