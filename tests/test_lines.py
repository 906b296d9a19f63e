"""Line codec: malformed lines, missing fields, bad clocks, round trip."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tremor.sources.lines import decode_lines, encode_lines
from tremor.streaming.alerts import alerts_from_lines


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_malformed_lines_are_dropped_without_error(spark):
    lines = _lines(spark, [
        "2024-01-01T00:00:00Z,1,2",                                   # 3 fields
        "2024-01-01T00:00:00Z,1,2,3,,p,t,Global",                     # empty mag
        "",                                                           # empty line
        "2024-01-01T00:00:00Z,1,2,3,abc,p,t,Global",                  # bad mag
        "2024-01-01T00:00:00Z,1,2,3,4.5,p,t,Global",                  # good
    ])
    rows = decode_lines(lines).collect()
    assert len(rows) == 1 and rows[0]["mag"] == 4.5


def test_empty_region_and_missing_region(spark):
    lines = _lines(spark, [
        "2024-01-01T00:00:00Z,30,70,10,5.5,p,t,",      # eight fields, empty region
        "2024-01-01T00:00:01Z,30,70,10,5.5,p,t",       # seven fields
    ])
    rows = alerts_from_lines(lines).orderBy("time").collect()
    assert rows[0]["region"] == "" and rows[0]["is_pakistan"] is False
    assert rows[1]["region"] is None and rows[1]["is_pakistan"] is None


def test_bad_clock_is_kept(spark):
    lines = _lines(spark, [",30,70,10,7.0,p,t,Pakistan", "yesterday,30,70,10,7.0,p,t,Pakistan"])
    rows = alerts_from_lines(lines).orderBy("time_raw").collect()
    assert [r["time"] for r in rows] == [None, None]
    assert [r["time_raw"] for r in rows] == ["", "yesterday"]
    assert {r["alert_level"] for r in rows} == {"CRITICAL !!"}


def test_encode_blanks_separators_and_missing(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5), None, 70.5, 10.0, 4.2, "5 km S of A,\nB ", None, "Global")],
        "time timestamp_ntz, latitude double, longitude double, depth double, mag double, "
        "place string, type string, region string",
    )
    (line,) = [r[0] for r in encode_lines(df).collect()]
    assert line == "2024-01-02T03:04:05.000000Z,,70.5,10.0,4.2,5 km S of A  B,,Global"


def test_encode_fills_missing_columns(spark):
    df = spark.createDataFrame([(4.2,)], "mag double")
    (line,) = [r[0] for r in encode_lines(df).collect()]
    assert line == ",,,,4.2,,,"


def test_round_trip_keeps_values(spark, catalog_small):
    back = decode_lines(encode_lines(catalog_small))
    src = catalog_small.filter(F.col("mag").isNotNull()).select(
        "time", "latitude", "longitude", "depth", "mag", "type", "region"
    )
    got = back.select(*src.columns)
    assert src.exceptAll(got).count() == 0 and got.exceptAll(src).count() == 0


def test_pass_through_columns_do_not_clash(spark):
    df = spark.createDataFrame([("k1", "old", "2024-01-01T00:00:00Z,30,70,10,4.5,p,t,Global")],
                               "key string, type string, value string")
    out = decode_lines(df)
    assert out.columns.count("type") == 1 and "key" in out.columns
    assert out.first()["type"] == "t"
