"""Operators on hand-made rows: normalization, merge/dedupe, aggregates, hotspots, views."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tremor.config import CATALOG_SCHEMA
from tremor.operators import (
    MissingColumnsError,
    assign_region,
    dedupe_keep_first,
    event_json,
    event_records,
    hotspots,
    hotspots_top,
    mag_range_counts,
    merge_feeds,
    merge_report,
    recent_events,
    regional_events,
    regional_stats,
    summary,
    top_places,
)
from tremor.sources import feed_slice, normalize, trailing_range

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _catalog(spark, rows):
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _row(time=T0, lat=30.0, lon=70.0, depth=10.0, mag=3.0, place="p", type_="earthquake", region="Pakistan"):
    return (time, lat, lon, depth, mag, place, type_, region)


# -- normalize ----------------------------------------------------------------

def test_normalize_fills_coerces_and_keeps_extras(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:00Z", "30.5", "x", "NaN", "id1"), ("bad", "", "70", "4.5", "id2")],
        "time string, latitude string, longitude string, mag string, id string",
    )
    out = normalize(df)
    types = dict(out.dtypes)
    assert types["time"] == "timestamp_ntz" and types["mag"] == "double" and types["depth"] == "double"
    assert types["region"] == "string" and types["id"] == "string"
    rows = {r["id"]: r for r in out.collect()}
    assert rows["id1"]["time"] == dt.datetime(2024, 1, 1) and rows["id1"]["latitude"] == 30.5
    assert rows["id1"]["longitude"] is None and rows["id1"]["mag"] is None
    assert rows["id2"]["time"] is None and rows["id2"]["longitude"] == 70.0 and rows["id2"]["mag"] == 4.5
    assert rows["id2"]["place"] is None and rows["id2"]["type"] is None


def test_assign_region_requires_coordinates(spark):
    with pytest.raises(MissingColumnsError):
        assign_region(spark.createDataFrame([(1.0,)], "latitude double"))


# -- feeds -------------------------------------------------------------------

def test_feed_slice_bounds_are_inclusive(spark):
    start, end = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [
        _row(time=dt.datetime(2023, 12, 31, 23, 59, 59), mag=3.0),
        _row(time=dt.datetime(2024, 1, 1), mag=2.5),
        _row(time=dt.datetime(2024, 1, 2), mag=2.49),
        _row(time=dt.datetime(2024, 1, 2), mag=2.5, lat=40.0),
        _row(time=dt.datetime(2024, 1, 2, 0, 0, 1), mag=5.0),
    ]
    df = _catalog(spark, rows)
    assert feed_slice(df, start, end, 2.5).count() == 2
    from tremor.config import DEFAULT_REGION

    assert feed_slice(df, start, end, 2.5, DEFAULT_REGION).count() == 1


def test_trailing_range():
    assert trailing_range(30, dt.date(2024, 1, 31)) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))


# -- merge ---------------------------------------------------------------------

def test_merge_keeps_first_feed_row(spark):
    global_feed = spark.createDataFrame([(T0, 30.0, 70.0, 4.5, "global place")],
                                        "time timestamp_ntz, latitude double, longitude double, mag double, place string")
    regional_feed = spark.createDataFrame([(T0, 30.0, 70.0, 4.5, "regional place", "extra")],
                                          "time timestamp_ntz, latitude double, longitude double, mag double, "
                                          "place string, net string")
    merged = merge_feeds([global_feed, regional_feed]).collect()
    assert len(merged) == 1
    assert merged[0]["place"] == "global place" and merged[0]["region"] == "Pakistan"
    assert merged[0]["net"] is None and "feed" not in merged[0].asDict()


def test_dedupe_null_keys_are_equal(spark):
    df = spark.createDataFrame([(T0, None, "a"), (T0, None, "b"), (T0, 1.0, "c")],
                               "time timestamp_ntz, mag double, place string")
    out = dedupe_keep_first(df).orderBy("place").collect()
    assert [r["place"] for r in out] == ["a", "c"]


def test_dedupe_is_independent_of_partitioning(spark):
    rows = [(T0 + dt.timedelta(seconds=i % 50), float(i % 7), f"p{i}", i % 2) for i in range(2000)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, mag double, place string, feed int")
    want = sorted(map(tuple, dedupe_keep_first(df.coalesce(1)).collect()))
    for seed in (1, 2, 3):
        shuffled = df.orderBy(F.rand(seed)).repartition(7)
        assert sorted(map(tuple, dedupe_keep_first(shuffled).collect())) == want


def test_dedupe_without_keys_drops_identical_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0)], "place string, depth double")
    assert dedupe_keep_first(df).count() == 2


def test_merge_report_counts(spark):
    df = _catalog(spark, [_row(), _row(region="Global"), _row(region="Global")])
    r = merge_report(df).collect()[0]
    assert (r["total"], r["pakistan_count"], r["global_count"]) == (3, 1, 2)


# -- aggregates ----------------------------------------------------------------

def test_mag_range_counts_null_is_major(spark):
    df = _catalog(spark, [_row(mag=None), _row(mag=9.0), _row(mag=1.0)])
    got = {r["mag_range"]: r["count"] for r in mag_range_counts(df).collect()}
    assert got == {"Major": 2, "Minor": 1}


def test_top_places_null_group_and_ties(spark):
    rows = [_row(place=None)] * 3 + [_row(place="b")] * 2 + [_row(place="a")] * 2 + [_row(place="c")]
    out = top_places(_catalog(spark, rows), n=3).collect()
    assert [(r["place"], r["count"]) for r in out] == [(None, 3), ("a", 2), ("b", 2)]


def test_regional_stats_empty_region_gives_one_row(spark):
    df = _catalog(spark, [_row(region="Global")])
    (r,) = regional_stats(df).collect()
    assert r["total"] == 0 and r["avg_mag"] is None and r["max_mag"] is None


def test_summary_counts_and_rounding(spark):
    rows = [_row(mag=6.5), _row(mag=6.0, region="Global"), _row(mag=5.01), _row(mag=None), _row(mag=float("nan"))]
    (r,) = summary(_catalog(spark, rows)).collect()
    assert r["total_earthquakes"] == 5 and r["pakistan_count"] == 4
    assert r["critical_count"] == 1 and r["high_count"] == 2
    assert r["average_magnitude"] == round((6.5 + 6.0 + 5.01) / 3, 2) and r["max_magnitude"] == 6.5


def test_summary_empty_catalog(spark):
    (r,) = summary(_catalog(spark, [])).collect()
    assert r["total_earthquakes"] == 0 and r["average_magnitude"] == 0.0 and r["max_magnitude"] == 0.0


# -- hotspots ------------------------------------------------------------------

def test_hotspots_keep_null_cell_and_label_risk(spark):
    rows = [_row(lat=30.04, lon=70.04)] * 11 + [_row(lat=None, lon=70.0)]
    out = {(r["lat_grid"], r["lon_grid"]): (r["count"], r["risk_level"]) for r in hotspots(_catalog(spark, rows)).collect()}
    assert out == {(30.0, 70.0): (11, "MEDIUM"), (None, 70.0): (1, "LOW")}


def test_hotspots_region_filter(spark):
    rows = [_row(), _row(region="Global", lat=0.0, lon=0.0)]
    assert hotspots(_catalog(spark, rows), region="Pakistan").count() == 1
    assert hotspots(_catalog(spark, rows), region=None).count() == 2
    assert hotspots(_catalog(spark, rows), region="").count() == 2


def test_hotspots_top_drops_missing_and_rounds_half_even(spark):
    rows = [_row(lat=0.25, lon=0.25)] * 2 + [_row(lat=None)] * 5
    out = hotspots_top(_catalog(spark, rows)).collect()
    assert [(r["latitude"], r["longitude"], r["count"]) for r in out] == [(0.2, 0.2, 2)]


# -- views -----------------------------------------------------------------------

def test_records_and_json(spark):
    rows = [_row(time=dt.datetime(2024, 1, 1, 0, 0, 0, 500), mag=6.2, place=None)]
    (rec,) = event_records(_catalog(spark, rows)).collect()
    assert rec["time"] == "2024-01-01T00:00:00.000500+00:00" and rec["alert_level"] == "CRITICAL"
    (text,) = [r[0] for r in event_json(_catalog(spark, rows)).collect()]
    parsed = json.loads(text)
    assert parsed["place"] is None and parsed["mag"] == 6.2 and list(parsed)[-1] == "alert_level"


def test_recent_and_regional_order(spark):
    rows = [
        _row(time=None, mag=1.0),
        _row(time=T0, mag=2.0),
        _row(time=T0 + dt.timedelta(hours=1), mag=3.0, region="Global"),
    ]
    recent = [r["mag"] for r in recent_events(_catalog(spark, rows), n=2).collect()]
    assert recent == [3.0, 2.0]
    regional = [r["mag"] for r in regional_events(_catalog(spark, rows)).collect()]
    assert regional == [2.0, 1.0]


def test_dedupe_on_the_key_column_that_exists(spark):
    # only ``mag`` is present: it alone is the key, and the earlier feed wins
    a = spark.createDataFrame([(4.5, "a1"), (5.0, "a2")], "mag double, place string")
    b = spark.createDataFrame([(4.5, "b1"), (6.0, "b2")], "mag double, place string")
    from tremor.operators import union_feeds

    out = sorted((r["mag"], r["place"]) for r in dedupe_keep_first(union_feeds([a, b])).collect())
    assert out == [(4.5, "a1"), (5.0, "a2"), (6.0, "b2")]


def test_summary_rounds_like_python(spark):
    # the average is exactly 4.125: Python's round gives 4.12, SQL round would give 4.13
    rows = [_row(mag=4.0), _row(mag=4.25)]
    (r,) = summary(_catalog(spark, rows)).collect()
    assert r["average_magnitude"] == round(4.125, 2) == 4.12


def test_summary_average_on_a_stored_tie(spark):
    # (2.65 + 2.70) / 2 is stored as 2.67499999…: Python's round gives 2.67
    rows = [_row(mag=2.65), _row(mag=2.70)]
    (r,) = summary(_catalog(spark, rows)).collect()
    assert r["average_magnitude"] == round((2.65 + 2.70) / 2, 2) == 2.67
