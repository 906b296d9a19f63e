"""Jobs end to end on the smallest tables: landed CSV feeds → catalog →
analysis and hotspot outputs → replayed lines → alert stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tremor.operators import analytics, grid
from tremor.plans import jobs
from tremor.sinks import write_result
from tremor.sources import EmptyFeedError, read_feed
from tremor.sources.fixture import fixture_feeds


def test_catalog_build_then_batch_jobs(spark, tmp_dir):
    global_feed, regional_feed = fixture_feeds(spark, SF_SMALL)
    write_result(global_feed, f"{tmp_dir}/feeds/global", fmt="csv")
    write_result(regional_feed, f"{tmp_dir}/feeds/regional", fmt="csv")

    report = jobs.build_catalog(
        spark, [f"{tmp_dir}/feeds/global", f"{tmp_dir}/feeds/regional"], f"{tmp_dir}/catalog", fmt="csv"
    ).first()
    catalog = spark.read.parquet(f"{tmp_dir}/catalog")
    expected = jobs.merge.merge_feeds([global_feed, regional_feed])
    assert report["total"] == expected.count() == catalog.count()
    assert report["pakistan_count"] + report["global_count"] == report["total"]
    # the CSV hop keeps every value (event_id comes back as text: extra columns are not typed)
    back = catalog.withColumn("event_id", F.col("event_id").cast("bigint")).select(*expected.columns)
    assert back.exceptAll(expected).count() == 0

    total = jobs.run_batch_analysis(spark, f"{tmp_dir}/catalog", f"{tmp_dir}/batch", fmt="csv")
    assert total == report["total"]
    top = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_dir}/batch/top_places")
    assert top.count() == 10

    previews = jobs.run_hotspots(spark, f"{tmp_dir}/catalog", f"{tmp_dir}/hot")
    cells = spark.read.parquet(f"{tmp_dir}/hot/global")
    assert cells.count() == grid.hotspots(catalog).count()
    assert len(previews["global"]) == min(10, cells.count()) and len(previews["pakistan"]) <= 5
    assert previews["global"][0]["count"] == cells.agg(F.max("count")).first()[0]


def test_empty_feed_is_rejected(spark, tmp_dir):
    empty = spark.createDataFrame([], "time string, mag string")
    write_result(empty, f"{tmp_dir}/empty", fmt="csv")
    try:
        read_feed(spark, f"{tmp_dir}/empty", "global", fmt="csv")
    except EmptyFeedError as exc:
        assert "global" in str(exc)
    else:
        raise AssertionError("empty feed accepted")


def test_replay_and_alert_job(spark, catalog_small, tmp_dir):
    catalog_small.write.parquet(f"{tmp_dir}/cat")
    jobs.replay_catalog(spark, f"{tmp_dir}/cat", f"{tmp_dir}/lines")
    jobs.run_alert_stream(
        spark, f"{tmp_dir}/lines", f"{tmp_dir}/archive", f"{tmp_dir}/ckpt",
        watch_path=f"{tmp_dir}/watch", trigger={"availableNow": True}, timeout=300,
    )
    archive = spark.read.parquet(f"{tmp_dir}/archive")
    assert archive.count() == catalog_small.filter(F.col("mag") > 6).count()
    watch = spark.read.parquet(f"{tmp_dir}/watch")
    assert watch.count() == catalog_small.filter(F.col("mag") > 5).count()


def test_workload_has_five_actions(catalog_small):
    w = jobs.workload(catalog_small)
    assert list(w) == ["catalog_count", "mag_range_counts", "region_counts", "top_places", "regional_avg_mag"]
    assert w["catalog_count"].first()["count"] == catalog_small.count()
    assert analytics.regional_avg_mag(catalog_small).first()[0] == w["regional_avg_mag"].first()[0]


def test_cli_batch_and_hotspots(spark, catalog_small, tmp_dir):
    catalog_small.write.parquet(f"{tmp_dir}/cat")
    assert jobs.main(["batch-analysis", "--catalog", f"{tmp_dir}/cat", "--out", f"{tmp_dir}/b"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/b/mag_ranges").count() == 5
    assert jobs.main(["hotspots", "--catalog", f"{tmp_dir}/cat", "--out", f"{tmp_dir}/h", "--format", "csv"]) == 0
    assert spark.read.option("header", True).csv(f"{tmp_dir}/h/global").count() == grid.hotspots(catalog_small).count()


def test_sizing_conf():
    from tremor.session import sizing_conf

    small = sizing_conf(10 << 20, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    huge = sizing_conf(100 * 10**12, total_cores=8000)
    assert int(huge["spark.sql.shuffle.partitions"]) == 93133
    capped = sizing_conf(10**16, total_cores=8000)
    assert capped["spark.sql.shuffle.partitions"] == "100000"


def test_fused_profiles_equal_direct_operators(spark, catalog_small):
    from tremor.session import reliable_checkpoint

    tables = analytics.profile_tables(reliable_checkpoint(analytics.range_region_profile(catalog_small)))
    for name in ("catalog_count", "mag_range_counts", "region_counts"):
        direct = getattr(analytics, name)(catalog_small)
        assert tables[name].collect() == direct.collect(), name
    fused, direct = tables["regional_stats"].first(), analytics.regional_stats(catalog_small).first()
    assert (fused["total"], fused["max_mag"], fused["min_mag"]) == (direct["total"], direct["max_mag"], direct["min_mag"])
    assert abs(fused["avg_mag"] - direct["avg_mag"]) < 1e-9

    cells = reliable_checkpoint(grid.cell_profile(catalog_small))
    for regional, region in ((False, None), (True, "Pakistan")):
        got = grid.profile_hotspots(cells, regional=regional)
        want = grid.hotspots(catalog_small, region=region, sort=False)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_alert_job_fused(spark, catalog_small, tmp_dir):
    catalog_small.write.parquet(f"{tmp_dir}/cat")
    jobs.replay_catalog(spark, f"{tmp_dir}/cat", f"{tmp_dir}/lines")
    jobs.run_alert_stream(spark, f"{tmp_dir}/lines", f"{tmp_dir}/archive", f"{tmp_dir}/ckpt",
                          watch_path=f"{tmp_dir}/watch", trigger={"availableNow": True}, timeout=300, fused=True)
    assert spark.read.parquet(f"{tmp_dir}/archive").count() == catalog_small.filter(F.col("mag") > 6).count()
    assert spark.read.parquet(f"{tmp_dir}/watch").count() == catalog_small.filter(F.col("mag") > 5).count()


def test_slice_feeds_from_archive(spark, catalog_small):
    import datetime as dt

    g, r = jobs.slice_feeds(catalog_small, days=30, as_of=dt.date(2024, 1, 20))
    start, end = dt.datetime(2023, 12, 21), dt.datetime(2024, 1, 20)
    in_window = (F.col("time") >= F.lit(start)) & (F.col("time") <= F.lit(end))
    assert "region" not in g.columns
    assert g.count() == catalog_small.filter(in_window & (F.col("mag") >= 2.5)).count()
    assert r.count() == catalog_small.filter(in_window & (F.col("mag") >= 2.0) & (F.col("region") == "Pakistan")).count()
    merged = jobs.merge.merge_feeds([g, r])
    assert merged.count() == catalog_small.filter(
        in_window & ((F.col("mag") >= 2.5) | ((F.col("mag") >= 2.0) & (F.col("region") == "Pakistan")))
    ).count()


def test_export_views(spark, catalog_small, tmp_dir):
    catalog_small.write.parquet(f"{tmp_dir}/cat")
    assert jobs.main(["export-views", "--catalog", f"{tmp_dir}/cat", "--out", f"{tmp_dir}/views"]) == 0
    summary = spark.read.json(f"{tmp_dir}/views/summary").first()
    assert summary["total_earthquakes"] == catalog_small.count()
    assert spark.read.json(f"{tmp_dir}/views/hotspots").count() == 20
    assert spark.read.json(f"{tmp_dir}/views/recent").count() == 100
    regional = spark.read.json(f"{tmp_dir}/views/pakistan")
    assert regional.count() == catalog_small.filter(F.col("region") == "Pakistan").count()
    assert "place" in regional.columns  # null fields are written, not dropped


def test_cli_build_catalog_from_archive(spark, catalog_small, tmp_dir):
    catalog_small.write.parquet(f"{tmp_dir}/archive")
    assert jobs.main(["build-catalog", "--archive", f"{tmp_dir}/archive", "--format", "parquet",
                      "--days", "30", "--as-of", "2024-01-20", "--out", f"{tmp_dir}/cat"]) == 0
    import datetime as dt

    want = jobs.merge.merge_feeds(jobs.slice_feeds(catalog_small, 30, dt.date(2024, 1, 20)))
    got = spark.read.parquet(f"{tmp_dir}/cat").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_windowed_batch_analysis_on_a_dated_catalog(spark, catalog_small, tmp_dir):
    import datetime as dt

    from tremor.sinks import write_catalog
    from tremor.sources import trailing_window

    write_catalog(catalog_small, f"{tmp_dir}/dated", by_date=True)
    assert jobs.main(["batch-analysis", "--catalog", f"{tmp_dir}/dated", "--out", f"{tmp_dir}/b",
                      "--days", "7", "--as-of", "2024-01-15"]) == 0
    window = trailing_window(catalog_small, 7, dt.date(2024, 1, 15))
    got = {r["mag_range"]: r["count"] for r in spark.read.parquet(f"{tmp_dir}/b/mag_ranges").collect()}
    want = {r["mag_range"]: r["count"] for r in analytics.mag_range_counts(window).collect()}
    assert got == want and sum(got.values()) < catalog_small.count()
