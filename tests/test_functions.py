"""Ladder boundaries, region box edges, rounding modes, coercion and time rules."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tremor.functions import (
    alert_level,
    grid_snap,
    iso_utc,
    mag_range,
    parse_utc_time,
    region_flag,
    region_label,
    risk_level,
    stream_alert_level,
    to_double,
)


def _col(spark, values, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def _labels(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_mag_range_boundaries(spark):
    df = _col(spark, [1.9, 2.0, 3.9, 4.0, 5.9, 6.0, 8.0, 8.1, None])
    assert _labels(df, mag_range(F.col("v"))) == [
        "Minor", "Light", "Light", "Moderate", "Moderate", "Strong", "Strong", "Major", "Major",
    ]


def test_mag_range_null_label(spark):
    df = _col(spark, [1.0, None, 9.0])
    assert _labels(df, mag_range(F.col("v"), null_label="Unknown")) == ["Minor", "Unknown", "Major"]


def test_alert_level_boundaries(spark):
    df = _col(spark, [4.0, 4.1, 5.0, 5.1, 6.0, 6.1, None, float("nan")])
    assert _labels(df, alert_level(F.col("v"))) == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "LOW", "LOW",
    ]


def test_stream_alert_relabels_top_only(spark):
    df = _col(spark, [6.1, 5.5, 4.5, 1.0, float("nan")])
    assert _labels(df, stream_alert_level(F.col("v"))) == ["CRITICAL !!", "HIGH", "MEDIUM", "LOW", "LOW"]


def test_risk_level_boundaries(spark):
    df = _col(spark, [10, 11, 30, 31, 50, 51], "bigint")
    assert _labels(df, risk_level(F.col("v"))) == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_region_box_is_closed(spark):
    df = spark.createDataFrame(
        [(0, 23.0, 60.0), (1, 37.0, 77.0), (2, 22.99, 60.0), (3, 37.0, 77.01), (4, None, 70.0)],
        "i int, lat double, lon double",
    )
    assert _labels(df, region_label(F.col("lat"), F.col("lon"))) == [
        "Pakistan", "Pakistan", "Global", "Global", "Global",
    ]


def test_region_flag_keeps_null(spark):
    df = spark.createDataFrame([(0, "Pakistan"), (1, "Global"), (2, ""), (3, None)], "i int, r string")
    assert _labels(df, region_flag(F.col("r"))) == [True, False, False, None]


def test_grid_rounding_modes(spark):
    df = _col(spark, [0.25, 0.05, -0.25])
    assert _labels(df, grid_snap(F.col("v"), 1, "half_up")) == [0.3, 0.1, -0.3]
    assert _labels(df, grid_snap(F.col("v"), 1, "half_even")) == [0.2, 0.0, -0.2]
    with pytest.raises(ValueError):
        grid_snap(F.col("v"), 1, "ceiling")


def test_to_double_is_lenient(spark):
    df = _col(spark, ["3.5", " 2 ", "", "abc", "NaN", None], "string")
    assert _labels(df, to_double(F.col("v"))) == [3.5, 2.0, None, None, None, None]


def test_parse_utc_time_spellings(spark):
    df = _col(
        spark,
        [
            "2024-01-02T03:04:05.123456Z",
            "2024-01-02T08:04:05.123456+05:00",
            "2024-01-02 03:04:05.123456",
            "2024-01-02T03:04:05+00:00",
            "2024-01-02",
            "",
            "not a time",
            None,
        ],
        "string",
    )
    expected = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    got = _labels(df, parse_utc_time(F.col("v")))
    assert got[:3] == [expected] * 3
    assert got[3] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[4] == dt.datetime(2024, 1, 2)
    assert got[5:] == [None, None, None]


def test_parse_utc_time_ignores_session_zone(spark):
    df = _col(spark, ["2024-01-02T03:04:05Z", "2024-01-02 03:04:05"], "string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
    try:
        got = _labels(df, parse_utc_time(F.col("v")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5)] * 2


def test_iso_utc_matches_isoformat(spark):
    values = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120000), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v timestamp_ntz")
    want = [v.replace(tzinfo=dt.timezone.utc).isoformat() if v else None for v in values]
    assert _labels(df, iso_utc(F.col("v"))) == want


def test_time_text_ignores_session_zone_even_in_a_dst_gap(spark):
    from tremor.functions import line_time_text

    gap = dt.datetime(2024, 3, 10, 2, 30, 0, 5)  # does not exist in America/Los_Angeles
    values = [gap, dt.datetime(2024, 1, 1), dt.datetime(1999, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        iso = _labels(df, iso_utc(F.col("v")))
        line = _labels(df, line_time_text(F.col("v")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert iso == [v.replace(tzinfo=dt.timezone.utc).isoformat() for v in values]
    assert line == [v.strftime("%Y-%m-%dT%H:%M:%S.%fZ") for v in values]


def test_zoned_text_in_a_repeated_hour(spark):
    # 08:30Z and 09:30Z are both 01:30 local time in Los Angeles on this day
    df = _col(spark, ["2024-11-03T08:30:00Z", "2024-11-03T09:30:00.000001Z", "2024-11-03T01:30:00-08:00"], "string")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = _labels(df, parse_utc_time(F.col("v")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2024, 11, 3, 8, 30), dt.datetime(2024, 11, 3, 9, 30, 0, 1), dt.datetime(2024, 11, 3, 9, 30)]


def test_offset_spellings(spark):
    texts = ["2024-01-02T08:34:05+05:30", "2024-01-02T08:34:05+0530", "2024-01-02T08:04:05+05",
             "2024-01-01T19:04:05-08:00", "2024-01-02 03:04:05 Z", "2024-01-02T03:04:05.5Z"]
    got = _labels(_col(spark, texts, "string"), parse_utc_time(F.col("v")))
    base = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got == [base] * 5 + [base.replace(microsecond=500000)]


def test_round_like_python_edges(spark):
    from tremor.functions import round_like_python

    values = [1e300, -1e17, float("inf"), float("nan"), None, 123456789.125]
    got = _labels(_col(spark, values), round_like_python(F.col("v"), 2))
    assert got[:3] == [1e300, -1e17, float("inf")] and got[3] != got[3] and got[4] is None
    assert got[5] == round(123456789.125, 2)
