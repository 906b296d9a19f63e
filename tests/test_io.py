"""Sources and sinks: landed CSV, catalog layout, console/processing-time streams."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from tremor.operators import analytics, filter_region
from tremor.sinks import write_catalog, write_lines
from tremor.sources import read_catalog
from tremor.streaming import alerts_from_lines, await_any, line_stream, start_alert_queries


def test_landed_csv_with_extras_and_junk(spark, tmp_dir):
    path = f"{tmp_dir}/feed.csv"
    with open(path, "w") as fh:
        fh.write("time,latitude,longitude,depth,mag,magType,place,type,id\n")
        fh.write('2024-01-02T03:04:05.120Z,30.5,70.25,10,4.6,mb,"12 km N of Town, Region",earthquake,ab1\n')
        fh.write("2024-01-02T04:00:00Z,,-120,5.5,,ml,,explosion,ab2\n")
        fh.write("garbage,x,y,z,w,ml,somewhere,earthquake,ab3\n")
    cat = read_catalog(spark, path, fmt="csv")
    assert {"magType", "id", "region"} <= set(cat.columns)
    rows = {r["id"]: r for r in cat.collect()}
    assert rows["ab1"]["time"] == dt.datetime(2024, 1, 2, 3, 4, 5, 120000)
    assert rows["ab1"]["place"] == "12 km N of Town, Region" and rows["ab1"]["depth"] == 10.0
    assert rows["ab2"]["latitude"] is None and rows["ab2"]["mag"] is None and rows["ab2"]["longitude"] == -120.0
    assert rows["ab3"]["time"] is None and rows["ab3"]["mag"] is None and rows["ab3"]["place"] == "somewhere"
    assert rows["ab1"]["region"] is None  # not derived here: a raw feed carries no region


def test_partitioned_catalog_reads_back_by_region(spark, catalog_small, tmp_dir):
    write_catalog(catalog_small, f"{tmp_dir}/cat")
    folders = sorted(d for d in os.listdir(f"{tmp_dir}/cat") if d.startswith("region="))
    assert folders == ["region=Global", "region=Pakistan"]
    back = spark.read.parquet(f"{tmp_dir}/cat")
    regional = filter_region(back)
    assert regional.count() == catalog_small.filter(F.col("region") == "Pakistan").count()
    a = analytics.regional_stats(back).first()
    b = analytics.regional_stats(catalog_small).first()
    assert (a["total"], a["max_mag"], a["min_mag"]) == (b["total"], b["max_mag"], b["min_mag"])


def test_await_any_stops_both_queries(spark, catalog_small, tmp_dir):
    write_lines(catalog_small, f"{tmp_dir}/lines")
    alerts = alerts_from_lines(line_stream(spark, f"{tmp_dir}/lines"))
    queries = start_alert_queries(
        alerts, f"{tmp_dir}/archive", f"{tmp_dir}/ckpt", watch_path=None,
        trigger={"processingTime": "1 second"},
    )
    for q in queries:  # drain the input first, so the check below cannot race a slow batch
        q.processAllAvailable()
    await_any(spark, queries, timeout=2)
    assert not any(q.isActive for q in queries)
    assert spark.read.parquet(f"{tmp_dir}/archive").count() == catalog_small.filter(F.col("mag") > 6).count()


def test_scratch_root_uses_the_shared_checkpoint_setting(spark):
    from tremor.session import scratch_path, scratch_root

    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    assert scratch_path(spark, "x").startswith(root + "/tremor/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_date_layout_prunes_time_windows(spark, catalog_small, tmp_dir):
    import contextlib
    import datetime as dt
    import io as _io

    from tremor.sources import feed_slice

    write_catalog(catalog_small, f"{tmp_dir}/dated", by_date=True)
    dated = spark.read.parquet(f"{tmp_dir}/dated")
    start, end = dt.date(2024, 1, 8), dt.date(2024, 1, 15)
    got = feed_slice(dated, start, end, 2.5).drop("event_date")
    want = feed_slice(catalog_small, start, end, 2.5)
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert want.select(*got.columns).exceptAll(got).count() == 0
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        feed_slice(dated, start, end, 2.5).explain(mode="formatted")
    assert "PartitionFilters: [isnotnull(event_date" in buf.getvalue()
