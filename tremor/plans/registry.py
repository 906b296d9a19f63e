"""Named queries over a test-data folder: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the folder's ``events`` table through the fixture adapter
(one catalog row per event), so its work grows with the data. Round-trip and
streaming queries write to a fresh folder under the session's shared scratch
root and return a frame read back from it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.config import (
    DEDUPE_KEYS,
    DEFAULT_REGION,
    GLOBAL_FEED_MIN_MAG,
    HOTSPOTS_PREVIEW_N,
    HOTSPOTS_REGIONAL_PREVIEW_N,
    REGIONAL_FEED_MIN_MAG,
)
from tremor.functions.cells import CELL_COLUMN
from tremor.functions.classify import alert_level, mag_range
from tremor.functions.numeric import grid_snap
from tremor.functions.time import iso_utc, line_time_text
from tremor.operators import analytics, grid, merge, regions, rollup, views
from tremor.plans.jobs import build_catalog, replay_catalog, run_batch_analysis, run_hotspots
from tremor.session import scratch_path
from tremor.sinks.refresh import refresh_catalog
from tremor.sinks.writers import write_catalog, write_lines, write_result
from tremor.sources.catalog import normalize, read_catalog
from tremor.sources.feeds import feed_slice, key_text_column, read_feed, trailing_window, with_key_text
from tremor.sources.fixture import fixture_feeds, load_catalog, raw_quakes, read_events
from tremor.sources.lines import decode_lines, encode_lines, reject_counts, rejected_lines
from tremor.streaming.alerts import (
    alerts_from_lines,
    classify_alerts,
    line_stream,
    run_bounded,
    start_alert_queries,
    start_reject_query,
)

# Parameters of the dated queries (the fixture's events fall in January 2024).
FEED_AS_OF = dt.date(2024, 1, 20)
FEED_DAYS = 30
TRAILING_AS_OF = dt.date(2024, 1, 15)
TRAILING_DAYS = 7
REFRESH_FROM = dt.date(2024, 1, 20)
# Files per micro-batch of the replayed alert stream: wide enough to occupy a
# cluster, small enough to bound one batch.
STREAM_FILES_PER_TRIGGER = 1000

# Zone spellings: the first three are read (five hours ahead, ahead and behind), the others are not.
ODD_ZONES = (" UTC+05:00", "+5:00", " GMT+5", " Asia/Karachi", "+05:30:00")
ODD_NUMBERS = ("abc", "5d", "5f", "5D", "0x1p3")
# Lines as a feed may send them: bad clock, too few fields, empty, junk, too many
# fields, a number in Java's spelling, empty fields.
MESSY_LINES = (
    "bad clock,1.0,2.0,3.0,7.5,Some Place,quake,Global",
    "2024-02-03T04:05:06Z,1.5,2.5,,6.5",
    "",
    "abc,def",
    "2024-02-03 04:05:06,91,181,x,5.5,A,B,Pakistan,extra,more",
    "2024-02-03T04:05:06Z,1,2,3,5d,P,T,Global",
    ",1,2,3,8.0,P,,",
)

QueryFn = Callable[[SparkSession, str], DataFrame]


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_catalog(spark, sf_dir)


# -- aggregates --------------------------------------------------------------

def q_catalog_count(spark, sf_dir):
    return analytics.catalog_count(_catalog(spark, sf_dir))


def q_mag_range_counts(spark, sf_dir):
    return analytics.mag_range_counts(_catalog(spark, sf_dir))


def q_region_counts(spark, sf_dir):
    return analytics.region_counts(_catalog(spark, sf_dir))


def q_top_places(spark, sf_dir):
    return analytics.top_places(_catalog(spark, sf_dir))


def q_regional_stats(spark, sf_dir):
    # avg is rounded to 6 places for the cross-engine check only: the last bits
    # of a floating-point sum depend on summation order, which differs by engine.
    stats = analytics.regional_stats(_catalog(spark, sf_dir))
    return stats.withColumn("avg_mag", F.round("avg_mag", 6))


def q_regional_avg_mag(spark, sf_dir):
    return analytics.regional_avg_mag(_catalog(spark, sf_dir)).withColumn("avg_mag", F.round("avg_mag", 6))


def q_summary(spark, sf_dir):
    return analytics.summary(_catalog(spark, sf_dir))


# -- per-row labels ----------------------------------------------------------

def q_classify_mag_range(spark, sf_dir):
    return _catalog(spark, sf_dir).select("event_id", mag_range(F.col("mag")).alias("mag_range"))


def q_classify_alert(spark, sf_dir):
    return _catalog(spark, sf_dir).select("event_id", alert_level(F.col("mag")).alias("alert_level"))


def q_classify_stream_alert(spark, sf_dir):
    return classify_alerts(_catalog(spark, sf_dir)).select("event_id", "alert_level", "is_pakistan")


def q_assign_region(spark, sf_dir):
    raw = raw_quakes(read_events(spark, sf_dir))
    return regions.assign_region(raw).select("event_id", "region")


def _raw_text_catalog(spark, sf_dir):
    """The catalog as text, the way a landed CSV arrives: three time spellings,
    some junk numbers, and no ``type`` column. Every row is kept; ``event_id``
    only decides which spelling a row gets and which fields turn into junk."""
    cat = _catalog(spark, sf_dir)
    eid = F.col("event_id")
    time_text = (
        F.when(eid % 61 == 3, F.lit("not a time"))
        .when((eid % 67).between(1, 5), F.concat(F.col("time").cast("string"), F.get(
            F.array(*map(F.lit, ODD_ZONES)), ((eid % 67) - 1).cast("int"))))
        .when(eid % 67 == 6, F.lit("T10:00:00Z"))
        .when(eid % 3 == 0, line_time_text(F.col("time")))
        .when(eid % 3 == 1, iso_utc(F.col("time")))
        .otherwise(F.col("time").cast("string"))
    )
    return cat.select(
        eid,
        time_text.alias("time"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        F.when(eid % 59 == 2, F.lit("NaN")).otherwise(F.col("depth").cast("string")).alias("depth"),
        F.when((eid % 53).between(11, 15), F.get(F.array(*map(F.lit, ODD_NUMBERS)), ((eid % 53) - 11).cast("int")))
        .otherwise(F.col("mag").cast("string")).alias("mag"),
        "place",
        "region",
    )


def q_normalize_catalog(spark, sf_dir):
    return normalize(_raw_text_catalog(spark, sf_dir))


# -- grid and hotspots -------------------------------------------------------

def q_grid_half_up(spark, sf_dir):
    return _catalog(spark, sf_dir).select(
        "event_id",
        grid_snap(F.col("latitude"), mode="half_up").alias("lat_grid"),
        grid_snap(F.col("longitude"), mode="half_up").alias("lon_grid"),
    )


def q_grid_half_even(spark, sf_dir):
    return _catalog(spark, sf_dir).select(
        "event_id",
        grid_snap(F.col("latitude"), mode="half_even").alias("lat_grid"),
        grid_snap(F.col("longitude"), mode="half_even").alias("lon_grid"),
    )


def q_hotspots(spark, sf_dir):
    return grid.hotspots(_catalog(spark, sf_dir))


def q_hotspots_regional(spark, sf_dir):
    return grid.hotspots(_catalog(spark, sf_dir), region=DEFAULT_REGION.name)


def q_hotspots_preview(spark, sf_dir):
    return grid.hotspots_preview(_catalog(spark, sf_dir), HOTSPOTS_PREVIEW_N)


def q_hotspots_regional_preview(spark, sf_dir):
    return grid.hotspots_preview(_catalog(spark, sf_dir), HOTSPOTS_REGIONAL_PREVIEW_N, DEFAULT_REGION.name)


def q_hotspots_top(spark, sf_dir):
    return grid.hotspots_top(_catalog(spark, sf_dir))


# -- feeds, merge, dedupe ----------------------------------------------------

def _feed_window():
    return FEED_AS_OF - dt.timedelta(days=FEED_DAYS), FEED_AS_OF


def q_feed_slice_global(spark, sf_dir):
    start, end = _feed_window()
    return feed_slice(raw_quakes(read_events(spark, sf_dir)), start, end, GLOBAL_FEED_MIN_MAG)


def q_feed_slice_regional(spark, sf_dir):
    start, end = _feed_window()
    return feed_slice(raw_quakes(read_events(spark, sf_dir)), start, end, REGIONAL_FEED_MIN_MAG, DEFAULT_REGION)


def q_feed_slice_by_cell(spark, sf_dir):
    # The regional feed request, answered from an archive sorted by place.
    path = scratch_path(spark, "catalog-by-cell")
    write_catalog(_catalog(spark, sf_dir), path, by_cell=True)
    start, end = _feed_window()
    archive = spark.read.parquet(path)
    return feed_slice(archive, start, end, REGIONAL_FEED_MIN_MAG, DEFAULT_REGION).drop("region", CELL_COLUMN)


def q_trailing_days(spark, sf_dir):
    return trailing_window(_catalog(spark, sf_dir), TRAILING_DAYS, TRAILING_AS_OF)


def q_union_feeds(spark, sf_dir):
    return merge.union_feeds(list(fixture_feeds(spark, sf_dir)))


def q_merge_feeds(spark, sf_dir):
    return merge.merge_feeds(list(fixture_feeds(spark, sf_dir)))


def q_merge_report(spark, sf_dir):
    return merge.merge_report(merge.merge_feeds(list(fixture_feeds(spark, sf_dir))))


def _messy_feeds(spark, sf_dir):
    """The two feeds, the second with a column of its own and without depths, and
    a third of events without a magnitude, half of them without a time too."""
    first, second = fixture_feeds(spark, sf_dir)
    raw = raw_quakes(read_events(spark, sf_dir))
    third = raw.where(F.col("event_id") % 97 == 13).withColumn(
        "time", F.when(F.col("event_id") % 2 == 1, F.col("time")))
    return [first, second.drop("depth").withColumn("felt", F.col("event_id") % 10), third]


def q_union_messy_feeds(spark, sf_dir):
    return merge.union_feeds(_messy_feeds(spark, sf_dir))


def q_merge_messy_feeds(spark, sf_dir):
    return merge.merge_feeds(_messy_feeds(spark, sf_dir))


def q_merge_messy_report(spark, sf_dir):
    return merge.merge_report(merge.merge_feeds(_messy_feeds(spark, sf_dir)))


def q_build_catalog_from_csv(spark, sf_dir):
    # Feeds landed as CSV text, then the whole build job.
    root = scratch_path(spark, "build")
    eid = F.col("event_id")
    raw = raw_quakes(read_events(spark, sf_dir)).withColumns({
        "time": F.when(eid % 61 == 3, F.concat(F.lit("bad clock "), (eid % 5).cast("string"))).otherwise(line_time_text(F.col("time"))),
        "mag": F.when(eid % 53 == 11, F.concat(F.lit("x"), (eid % 4).cast("string"))).otherwise(F.col("mag").cast("string")),
        "place": _odd_place(),
    })
    second = raw.where((eid % 3 == 0) | (eid % 7 == 0)).drop("depth").withColumns(
        {"place": F.concat(F.lit("R "), F.col("place")), "felt": eid % 10})
    write_result(raw.where(eid % 3 != 0), f"{root}/first", fmt="csv")
    write_result(second, f"{root}/second", fmt="csv")
    build_catalog(spark, [f"{root}/first", f"{root}/second"], f"{root}/catalog")
    return spark.read.parquet(f"{root}/catalog").withColumns(
        {"event_id": eid.try_cast("bigint"), "felt": F.col("felt").try_cast("bigint")})


def q_catalog_refresh(spark, sf_dir):
    # A stored catalog, then a feed of its last days with revised rows and new ones.
    path = scratch_path(spark, "refresh")
    eid = F.col("event_id")
    raw = with_key_text(raw_quakes(read_events(spark, sf_dir)))
    write_catalog(merge.merge_feeds([raw.where(eid % 3 != 0)], keep_key_text=True), path, by_date=True)
    recent = feed_slice(raw, start=REFRESH_FROM).where(eid % 2 == 0)
    revised = recent.withColumns({"depth": F.col("depth") + 1, "latitude": F.col("latitude") + (eid % 5)})
    refresh_catalog(spark, path, [revised])
    return spark.read.parquet(path).drop(*map(key_text_column, DEDUPE_KEYS))


def _refreshed_states(spark, sf_dir):
    # Daily states of a stored catalog; a feed of its last days is merged in, and only their states are made anew.
    root = scratch_path(spark, "states")
    eid = F.col("event_id")
    raw = with_key_text(raw_quakes(read_events(spark, sf_dir)))
    late = (eid % 4 == 0) & (F.col("time") >= F.lit(REFRESH_FROM))
    write_catalog(merge.merge_feeds([raw.where(~late)], keep_key_text=True), f"{root}/catalog", by_date=True)
    rollup.write_states(spark, f"{root}/catalog", f"{root}/states")
    feeds = [raw.where(late)]
    refresh_catalog(spark, f"{root}/catalog", feeds)
    rollup.refresh_states(spark, f"{root}/catalog", f"{root}/states", feeds)
    return rollup.read_states(spark, f"{root}/states")


def q_states_summary(spark, sf_dir):
    return rollup.summary(_refreshed_states(spark, sf_dir)[rollup.CELLS])


def q_states_hotspots(spark, sf_dir):
    return rollup.hotspots(_refreshed_states(spark, sf_dir)[rollup.CELLS])


def q_feed_folder_mixed_headers(spark, sf_dir):
    # One feed landed as files of two headers: other column order, a column less, a column more.
    root = scratch_path(spark, "feed-folder")
    eid = F.col("event_id")
    raw = raw_quakes(read_events(spark, sf_dir)).withColumn("place", _odd_place())
    write_result(raw.where(eid % 3 != 0), f"{root}/first", fmt="csv")
    second = raw.where(eid % 3 == 0).select("mag", "type", "place", "time", "longitude", "latitude", "event_id",
                                            (eid % 10).alias("felt"))
    write_result(second, f"{root}/second", fmt="csv")
    feed = read_feed(spark, f"{root}/*", "mixed").drop(*map(key_text_column, DEDUPE_KEYS))
    return feed.withColumns({"event_id": eid.try_cast("bigint"), "felt": F.col("felt").try_cast("bigint")})


def q_dedupe_full_row(spark, sf_dir):
    # Feeds without either key column: the merge falls back to whole-row dedupe.
    raw = raw_quakes(read_events(spark, sf_dir))
    g = feed_slice(raw, min_mag=GLOBAL_FEED_MIN_MAG).drop("time", "mag")
    r = feed_slice(raw, min_mag=REGIONAL_FEED_MIN_MAG, region=DEFAULT_REGION).drop("time", "mag")
    return merge.dedupe_keep_first(merge.union_feeds([g, r]))


# -- serving views -----------------------------------------------------------

def q_event_records(spark, sf_dir):
    return views.event_records(_catalog(spark, sf_dir))


def q_event_json(spark, sf_dir):
    return views.parse_event_json(views.event_json(_catalog(spark, sf_dir)))


def q_regional_events(spark, sf_dir):
    return views.regional_events(_catalog(spark, sf_dir))


def q_recent_events(spark, sf_dir):
    return views.recent_events(_catalog(spark, sf_dir))


# -- line codec and round trips ----------------------------------------------

def q_encode_lines(spark, sf_dir):
    lines = encode_lines(_catalog(spark, sf_dir))
    parts = F.split(F.col("value"), ",", -1)
    return lines.select(
        F.get(parts, 0).alias("time"),
        F.get(parts, 1).try_cast("double").alias("latitude"),
        F.get(parts, 2).try_cast("double").alias("longitude"),
        F.get(parts, 3).try_cast("double").alias("depth"),
        F.get(parts, 4).try_cast("double").alias("mag"),
        F.get(parts, 5).alias("place"),
        F.get(parts, 6).alias("type"),
        F.get(parts, 7).alias("region"),
        F.size(parts).alias("n_fields"),
    )


def _land_lines(spark, sf_dir, path: str) -> None:
    """The catalog as event lines, and for every fiftieth event a set of messy ones."""
    write_lines(_catalog(spark, sf_dir), path)
    some = read_events(spark, sf_dir).where(F.col("event_id") % 50 == 0)
    some.select(F.explode(F.array(*map(F.lit, MESSY_LINES))).alias("value")).write.mode("append").text(path)


def q_decode_lines(spark, sf_dir):
    # Lines at rest, as the stream source sees them: written once, then decoded from text.
    path = scratch_path(spark, "lines")
    _land_lines(spark, sf_dir, path)
    return decode_lines(spark.read.text(path))


def q_rejected_lines(spark, sf_dir):
    # What decode_lines leaves of the same lines.
    path = scratch_path(spark, "lines")
    _land_lines(spark, sf_dir, path)
    return rejected_lines(spark.read.text(path)).drop("value")


def q_stream_rejected_lines(spark, sf_dir):
    root = scratch_path(spark, "rejects")
    _land_lines(spark, sf_dir, f"{root}/lines")
    lines = line_stream(spark, f"{root}/lines", max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    run_bounded([start_reject_query(lines, f"{root}/rejects", f"{root}/checkpoint", {"availableNow": True})])
    return reject_counts(spark.read.parquet(f"{root}/rejects"))


def _odd_place():
    """Places with quotes, doubled quotes, commas, blanks at the ends and line breaks."""
    eid, place = F.col("event_id"), F.col("place")
    return (F.when(eid % 13 == 0, F.concat(F.lit('5 km "N", '), place)).when(eid % 13 == 1, F.concat(F.lit("  "), place, F.lit("  ")))
            .when(eid % 13 == 2, F.concat(place, F.lit("\nsecond line"))).when(eid % 13 == 3, F.concat(F.lit('""'), place, F.lit('"')))
            .when(eid % 13 == 4, F.concat(place, F.lit("\r\n, end"))).otherwise(place))


def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_result(_catalog(spark, sf_dir).withColumn("place", _odd_place()), path, fmt="csv")
    back = read_catalog(spark, path, fmt="csv")
    return back.withColumn("event_id", F.col("event_id").try_cast("bigint"))


def q_catalog_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    write_catalog(_catalog(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_catalog_by_date_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "catalog-by-date")
    write_catalog(_catalog(spark, sf_dir), path, by_date=True)
    return spark.read.parquet(path)


# -- the fused tables of the jobs --------------------------------------------

def _batch_profile(spark, sf_dir, name):
    return analytics.profile_tables(analytics.range_region_profile(_catalog(spark, sf_dir)))[name]


def q_batch_profile_count(spark, sf_dir):
    return _batch_profile(spark, sf_dir, "catalog_count")


def q_batch_profile_mag_ranges(spark, sf_dir):
    return _batch_profile(spark, sf_dir, "mag_range_counts")


def q_batch_profile_regions(spark, sf_dir):
    return _batch_profile(spark, sf_dir, "region_counts")


def q_batch_profile_regional_stats(spark, sf_dir):
    return _batch_profile(spark, sf_dir, "regional_stats").withColumn("avg_mag", F.round("avg_mag", 6))


def q_cell_profile_hotspots(spark, sf_dir):
    return grid.profile_hotspots(grid.cell_profile(_catalog(spark, sf_dir)))


def q_cell_profile_hotspots_regional(spark, sf_dir):
    return grid.profile_hotspots(grid.cell_profile(_catalog(spark, sf_dir)), regional=True)


# -- whole jobs ---------------------------------------------------------------

def _stored_catalog(spark, sf_dir) -> str:
    path = scratch_path(spark, "job-catalog")
    write_catalog(_catalog(spark, sf_dir), path)
    return path


def q_batch_job_top_places(spark, sf_dir):
    out = scratch_path(spark, "batch-job")
    run_batch_analysis(spark, _stored_catalog(spark, sf_dir), out)
    return spark.read.parquet(f"{out}/top_places")


def q_hotspot_job_global(spark, sf_dir):
    out = scratch_path(spark, "hotspot-job")
    run_hotspots(spark, _stored_catalog(spark, sf_dir), out)
    return spark.read.parquet(f"{out}/global")


def q_replay_lines(spark, sf_dir):
    out = scratch_path(spark, "replay")
    replay_catalog(spark, _stored_catalog(spark, sf_dir), out)
    return decode_lines(spark.read.text(out))


# -- streaming ---------------------------------------------------------------

def _run_alert_stream(spark, sf_dir) -> tuple[str, str]:
    """Replay the catalog as line files, run both alert queries to completion
    (``availableNow``), return ``(watch_path, archive_path)``."""
    root = scratch_path(spark, "alerts")
    _land_lines(spark, sf_dir, f"{root}/lines")
    alerts = alerts_from_lines(line_stream(spark, f"{root}/lines", max_files_per_trigger=STREAM_FILES_PER_TRIGGER))
    queries = start_alert_queries(
        alerts,
        archive_path=f"{root}/archive",
        checkpoint_root=f"{root}/checkpoints",
        watch_path=f"{root}/watch",
        trigger={"availableNow": True},
    )
    run_bounded(queries)
    return f"{root}/watch", f"{root}/archive"


def q_stream_watch_alerts(spark, sf_dir):
    watch, _ = _run_alert_stream(spark, sf_dir)
    return spark.read.parquet(watch)


def q_stream_critical_alerts(spark, sf_dir):
    _, archive = _run_alert_stream(spark, sf_dir)
    return spark.read.parquet(archive)


QUERIES: dict[str, QueryFn] = {
    "catalog_count": q_catalog_count,
    "mag_range_counts": q_mag_range_counts,
    "region_counts": q_region_counts,
    "top_places": q_top_places,
    "regional_stats": q_regional_stats,
    "regional_avg_mag": q_regional_avg_mag,
    "summary": q_summary,
    "classify_mag_range": q_classify_mag_range,
    "classify_alert": q_classify_alert,
    "classify_stream_alert": q_classify_stream_alert,
    "assign_region": q_assign_region,
    "normalize_catalog": q_normalize_catalog,
    "grid_half_up": q_grid_half_up,
    "grid_half_even": q_grid_half_even,
    "hotspots": q_hotspots,
    "hotspots_regional": q_hotspots_regional,
    "hotspots_preview": q_hotspots_preview,
    "hotspots_regional_preview": q_hotspots_regional_preview,
    "hotspots_top": q_hotspots_top,
    "feed_slice_global": q_feed_slice_global,
    "feed_slice_regional": q_feed_slice_regional,
    "feed_slice_by_cell": q_feed_slice_by_cell,
    "trailing_days": q_trailing_days,
    "union_feeds": q_union_feeds,
    "merge_feeds": q_merge_feeds,
    "merge_report": q_merge_report,
    "dedupe_full_row": q_dedupe_full_row,
    "event_records": q_event_records,
    "event_json": q_event_json,
    "regional_events": q_regional_events,
    "recent_events": q_recent_events,
    "encode_lines": q_encode_lines,
    "decode_lines": q_decode_lines,
    "csv_roundtrip": q_csv_roundtrip,
    "catalog_roundtrip": q_catalog_roundtrip,
    "union_messy_feeds": q_union_messy_feeds,
    "merge_messy_feeds": q_merge_messy_feeds,
    "merge_messy_report": q_merge_messy_report,
    "build_catalog_from_csv": q_build_catalog_from_csv,
    "catalog_refresh": q_catalog_refresh,
    "states_summary": q_states_summary,
    "states_hotspots": q_states_hotspots,
    "feed_folder_mixed_headers": q_feed_folder_mixed_headers,
    "catalog_by_date_roundtrip": q_catalog_by_date_roundtrip,
    "batch_profile_count": q_batch_profile_count,
    "batch_profile_mag_ranges": q_batch_profile_mag_ranges,
    "batch_profile_regions": q_batch_profile_regions,
    "batch_profile_regional_stats": q_batch_profile_regional_stats,
    "cell_profile_hotspots": q_cell_profile_hotspots,
    "cell_profile_hotspots_regional": q_cell_profile_hotspots_regional,
    "batch_job_top_places": q_batch_job_top_places,
    "hotspot_job_global": q_hotspot_job_global,
    "replay_lines": q_replay_lines,
    "rejected_lines": q_rejected_lines,
    "stream_rejected_lines": q_stream_rejected_lines,
    "stream_watch_alerts": q_stream_watch_alerts,
    "stream_critical_alerts": q_stream_critical_alerts,
}
