"""End-to-end jobs composed from the operators.

Each job reads only the columns its outputs need (Parquet column pruning),
folds outputs that share columns into one aggregate pass, writes through
Spark's commit protocol, and sends at most a handful of summary rows to the
driver for the log. The catalog is never cached (it would not fit); the small
shared aggregates are checkpointed to the shared checkpoint folder instead,
which also cuts their lineage.

Run as ``python -m tremor.plans.jobs <job> ...``; see ``--help``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.config import (
    ALERT_STEPS,
    DEFAULT_REGION,
    FEED_DAYS,
    GLOBAL_FEED_MIN_MAG,
    HOTSPOTS_PREVIEW_N,
    HOTSPOTS_REGIONAL_PREVIEW_N,
    REGIONAL_FEED_MIN_MAG,
    STREAM_CRITICAL_LABEL,
    TOP_PLACES_N,
)
from tremor.operators import analytics, grid, merge, rollup, views
from tremor.session import build_session, reliable_checkpoint, size_for
from tremor.sinks import refresh_catalog, write_catalog, write_lines, write_result
from tremor.sources import feed_slice, read_catalog, read_feed, trailing_range, trailing_window
from tremor.streaming import (
    NO_AGE_LIMIT,
    alerts_from_lines,
    await_any,
    kafka_line_stream,
    line_stream,
    run_bounded,
    socket_line_stream,
    start_alert_queries,
    start_fused_alert_query,
    start_reject_query,
)


# -- catalog build -------------------------------------------------------------

def build_catalog(
    spark: SparkSession,
    feed_paths: Sequence[str],
    out_path: str,
    fmt: str = "csv",
    labels: Sequence[str] | None = None,
    by_date: bool = False,
    multi_line: bool | None = None,
    refreshable: bool = False,
    by_cell: bool = False,
) -> DataFrame:
    """Landed feeds (files, folders or globs; first = highest priority) → merged,
    region-tagged catalog laid out by region (and by UTC date with ``by_date``).
    Returns the one-row report (total and per-region), counted while writing.
    ``refreshable`` lays out by date and keeps the text of unreadable keys beside
    them, so that :func:`refresh` can go on from the catalog alone. ``by_cell``
    sorts the files by place, for box reads."""
    labels = list(labels or [f"feed{i}" for i in range(len(feed_paths))])
    feeds = [read_feed(spark, p, label, fmt=fmt, multi_line=multi_line) for p, label in zip(feed_paths, labels)]
    merged = merge.merge_feeds(feeds, keep_key_text=refreshable)
    return write_catalog(merged, out_path, by_date=by_date or refreshable, by_cell=by_cell,
                         metrics=merge.report_columns())


def refresh(spark: SparkSession, feed_paths: Sequence[str], catalog_path: str, fmt: str = "csv",
            labels: Sequence[str] | None = None, multi_line: bool | None = None,
            states_path: str | None = None) -> DataFrame:
    """Newly landed feeds (first = highest priority, all before what is stored)
    → the days they touch of a catalog laid out by date. Returns the report over
    those days. ``states_path``: the daily states kept beside the catalog; those
    of the touched days are made anew."""
    labels = list(labels or [f"feed{i}" for i in range(len(feed_paths))])
    feeds = [read_feed(spark, p, label, fmt=fmt, multi_line=multi_line) for p, label in zip(feed_paths, labels)]
    report = refresh_catalog(spark, catalog_path, feeds)
    if states_path:
        rollup.refresh_states(spark, catalog_path, states_path, feeds)
    return report


def slice_feeds(archive: DataFrame, days: int = FEED_DAYS, as_of=None) -> list[DataFrame]:
    """The two standard feed requests answered from an archive catalog:
    global (min magnitude 2.5) and regional (min 2.0, inside the box)."""
    start, end = trailing_range(days, as_of)
    slices = [
        feed_slice(archive, start, end, GLOBAL_FEED_MIN_MAG),
        feed_slice(archive, start, end, REGIONAL_FEED_MIN_MAG, DEFAULT_REGION),
    ]
    return [s.drop("region", "event_date", "cell") for s in slices]


# -- batch analysis --------------------------------------------------------------

def batch_outputs(catalog: DataFrame, region: str = DEFAULT_REGION.name) -> dict[str, DataFrame]:
    """The analysis results by output name, each computed directly (all lazy)."""
    return {
        "mag_ranges": analytics.mag_range_counts(catalog),
        "region_counts": analytics.region_counts(catalog),
        "top_places": analytics.top_places(catalog, TOP_PLACES_N),
        f"{region.lower()}_stats": analytics.regional_stats(catalog, region),
    }


def _windowed(catalog: DataFrame, days: int | None, as_of: dt.date | None) -> DataFrame:
    """The trailing ``days`` ending at ``as_of`` when ``days`` is given (on a
    catalog laid out by date this reads only those day folders)."""
    return trailing_window(catalog, days, as_of) if days else catalog


def run_batch_analysis(spark: SparkSession, catalog_path: str, out_base: str, fmt: str = "parquet",
                       catalog_fmt: str = "parquet", region: str = DEFAULT_REGION.name,
                       days: int | None = None, as_of: dt.date | None = None,
                       multi_line: bool | None = None) -> int:
    """Count plus four analyses, each written once. Returns the row count.

    Two passes over the catalog instead of five: one aggregate over
    ``(mag_range, region)`` (a few rows, checkpointed) yields the count, the
    range and region counts and the regional statistics; the places top-k is
    the second pass, over ``place`` only.
    """
    catalog = _windowed(read_catalog(spark, catalog_path, fmt=catalog_fmt, multi_line=multi_line), days, as_of)
    profile = reliable_checkpoint(analytics.range_region_profile(catalog))
    tables = analytics.profile_tables(profile, region)
    total = tables["catalog_count"].first()["count"]
    outputs = {
        "mag_ranges": tables["mag_range_counts"],
        "region_counts": tables["region_counts"],
        "top_places": analytics.top_places(catalog, TOP_PLACES_N),
        f"{region.lower()}_stats": tables["regional_stats"],
    }
    for name, df in outputs.items():
        write_result(df, f"{out_base}/{name}", fmt=fmt)
    return total


# -- hotspots ---------------------------------------------------------------------

def run_hotspots(spark: SparkSession, catalog_path: str, out_base: str, fmt: str = "parquet",
                 catalog_fmt: str = "parquet", region: str = DEFAULT_REGION.name,
                 days: int | None = None, as_of: dt.date | None = None,
                 multi_line: bool | None = None) -> dict[str, list]:
    """Global and regional hotspot tables (written unsorted), plus the top
    cells of each for the log.

    One pass over the catalog: a single cell aggregate carries both the total
    and the regional count per cell; it is bounded by the grid size and
    checkpointed, and both tables and their previews are read from it.
    """
    catalog = _windowed(read_catalog(spark, catalog_path, fmt=catalog_fmt, multi_line=multi_line), days, as_of)
    profile = reliable_checkpoint(grid.cell_profile(catalog, region))
    outputs = {
        "global": (grid.profile_hotspots(profile), HOTSPOTS_PREVIEW_N),
        region.lower(): (grid.profile_hotspots(profile, regional=True), HOTSPOTS_REGIONAL_PREVIEW_N),
    }
    previews = {}
    for name, (df, n) in outputs.items():
        write_result(df, f"{out_base}/{name}", fmt=fmt)
        previews[name] = df.orderBy(F.col("count").desc(), "lat_grid", "lon_grid").take(n)
    return previews


# -- streaming ----------------------------------------------------------------------

def run_alert_stream(
    spark: SparkSession,
    source: str,
    archive_path: str,
    checkpoint_root: str,
    watch_path: str | None = None,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
    timeout: float | None = None,
    fused: bool = False,
    max_file_age: str = NO_AGE_LIMIT,
    kafka_options: dict[str, str] | None = None,
    steps: Sequence[tuple[float, str]] = ALERT_STEPS,
    top_label: str = STREAM_CRITICAL_LABEL,
    console_rows: int = 20,
    rejects_path: str | None = None,
) -> None:
    """Start the watch and archive queries; with an ``availableNow`` trigger wait
    for both to drain their input, otherwise wait for either to end and stop both.
    There is no time limit unless ``timeout`` (seconds) is given.

    ``source``: a directory of line files, ``kafka://host:port/topic`` or
    ``socket://host:port``. A bounded run over Kafka starts at the earliest
    offset unless ``kafka_options`` says otherwise. With ``rejects_path`` a third
    query writes the lines that decode to nothing, with their reasons.
    """
    bounded = bool(trigger and trigger.get("availableNow"))
    if source.startswith("kafka://"):
        servers, topic = source[len("kafka://"):].split("/", 1)
        options = {"startingOffsets": "earliest"} if bounded else {}
        lines = kafka_line_stream(spark, servers, topic, **{**options, **(kafka_options or {})})
    elif source.startswith("socket://"):
        host, port = source[len("socket://"):].rsplit(":", 1)
        lines = socket_line_stream(spark, host, int(port))
    else:
        lines = line_stream(spark, source, max_files_per_trigger, max_file_age)
    alerts = alerts_from_lines(lines, steps=steps, top_label=top_label)
    how = {"trigger": trigger, "steps": steps, "console_rows": console_rows}
    if fused:  # one source read feeding both outputs
        queries = [start_fused_alert_query(alerts, archive_path, f"{checkpoint_root}/fused", watch_path, **how)]
    else:
        queries = list(start_alert_queries(alerts, archive_path, checkpoint_root, watch_path, **how))
    if rejects_path:
        try:
            queries.append(start_reject_query(lines, rejects_path, f"{checkpoint_root}/rejects", trigger))
        except Exception:
            for query in queries:
                query.stop()
            raise
    if bounded:
        # bounded catch-up: both queries drain their input and stop on their own
        run_bounded(queries, timeout)
    else:
        await_any(spark, queries, timeout)


def replay_catalog(spark: SparkSession, catalog_path: str, lines_path: str, catalog_fmt: str = "parquet",
                   multi_line: bool | None = None) -> None:
    """Write a stored catalog as event-line files for the alert stream."""
    write_lines(read_catalog(spark, catalog_path, fmt=catalog_fmt, multi_line=multi_line), lines_path)


# -- endpoint views ------------------------------------------------------------------

def endpoint_views(catalog: DataFrame, region: str = DEFAULT_REGION.name,
                   states: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The five read endpoints of the dashboard service as lazy frames: summary
    row, every event with its alert level, top cells, regional events newest
    first, and the most recent events. With ``states`` (:mod:`tremor.operators.rollup`)
    the summary and the cells are added up from them without a catalog scan."""
    cells = states[rollup.CELLS] if states else None
    return {
        "summary": rollup.summary(cells, region) if states else analytics.summary(catalog, region),
        "earthquakes": views.event_records(catalog),
        "hotspots": rollup.hotspots_top(cells) if states else grid.hotspots_top(catalog),
        region.lower(): views.regional_events(catalog, region),
        "recent": views.recent_events(catalog),
    }


def export_views(spark: SparkSession, catalog_path: str, out_base: str, catalog_fmt: str = "parquet",
                 region: str = DEFAULT_REGION.name, multi_line: bool | None = None,
                 states_path: str | None = None) -> None:
    """Write each endpoint view as JSON lines under ``out_base/<name>`` so the
    payloads can be served as static files instead of recomputed per request.
    ``states_path``: daily states of the same catalog, for the aggregates."""
    catalog = read_catalog(spark, catalog_path, fmt=catalog_fmt, multi_line=multi_line)
    states = rollup.read_states(spark, states_path) if states_path else None
    for name, df in endpoint_views(catalog, region, states).items():
        df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{out_base}/{name}")


# -- workload ------------------------------------------------------------------------

def workload(catalog: DataFrame, region: str = DEFAULT_REGION.name) -> dict[str, DataFrame]:
    """The five-action analysis workload: count, magnitude ranges, regions,
    top places, regional average magnitude."""
    return {
        "catalog_count": analytics.catalog_count(catalog),
        "mag_range_counts": analytics.mag_range_counts(catalog),
        "region_counts": analytics.region_counts(catalog),
        "top_places": analytics.top_places(catalog),
        "regional_avg_mag": analytics.regional_avg_mag(catalog, region),
    }


# -- command line ---------------------------------------------------------------------

#: Command-line spelling → ``multi_line`` of the readers.
MULTI_LINE = {"auto": None, "always": True, "never": False}


def _date(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def main(argv: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m tremor.plans.jobs")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="instead of the number derived from the input's size")
    p.add_argument("--multi-line", choices=list(MULTI_LINE), default="auto",
                   help="quoted line breaks in CSV: auto (split files, join records that cross lines), "
                        "always (one task per file), never (fail on them)")
    sub = p.add_subparsers(dest="job", required=True)

    b = sub.add_parser("build-catalog", help="merge landed feeds (or feeds sliced from an archive) into the catalog")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--feed", action="append", help="feed path, highest priority first")
    src.add_argument("--archive", help="catalog to answer the two standard feed requests from")
    b.add_argument("--days", type=int, default=FEED_DAYS, help="trailing window for --archive")
    b.add_argument("--as-of", default=None, help="window end date (YYYY-MM-DD, UTC) for --archive; default today")
    b.add_argument("--out", required=True)
    b.add_argument("--format", default="csv", choices=["csv", "parquet"])
    b.add_argument("--by-date", action="store_true", help="also lay the catalog out by UTC date")
    b.add_argument("--by-cell", action="store_true", help="sort the files by place, so that box reads prune")
    b.add_argument("--refreshable", action="store_true", help="by date, with what `refresh-catalog` needs")

    f = sub.add_parser("refresh-catalog", help="merge newly landed feeds into the days they touch of a catalog laid out by date")
    f.add_argument("--feed", action="append", required=True, help="feed path, highest priority first")
    f.add_argument("--catalog", required=True)
    f.add_argument("--format", default="csv", choices=["csv", "parquet"])
    f.add_argument("--states", default=None, help="daily states of the catalog, made anew for the touched days")

    d = sub.add_parser("daily-states", help="partial aggregates per day of a catalog laid out by date")
    d.add_argument("--catalog", required=True)
    d.add_argument("--out", required=True)

    a = sub.add_parser("batch-analysis", help="count, magnitude ranges, regions, top places, regional stats")
    a.add_argument("--catalog", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--catalog-format", default="parquet", choices=["csv", "parquet"])
    a.add_argument("--format", default="parquet", choices=["csv", "parquet"])
    a.add_argument("--days", type=int, default=None, help="analyse only the trailing N days")
    a.add_argument("--as-of", default=None, help="end date of --days (YYYY-MM-DD, UTC); default today")

    h = sub.add_parser("hotspots", help="global and regional grid hotspots")
    h.add_argument("--catalog", required=True)
    h.add_argument("--out", required=True)
    h.add_argument("--catalog-format", default="parquet", choices=["csv", "parquet"])
    h.add_argument("--format", default="parquet", choices=["csv", "parquet"])
    h.add_argument("--days", type=int, default=None, help="only the trailing N days")
    h.add_argument("--as-of", default=None, help="end date of --days (YYYY-MM-DD, UTC); default today")

    r = sub.add_parser("replay", help="write the catalog as event-line files")
    r.add_argument("--catalog", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--catalog-format", default="parquet", choices=["csv", "parquet"])

    v = sub.add_parser("export-views", help="write the endpoint views as JSON lines")
    v.add_argument("--catalog", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--catalog-format", default="parquet", choices=["csv", "parquet"])
    v.add_argument("--states", default=None, help="daily states of the catalog, to answer the aggregates from")

    s = sub.add_parser("alerts", help="run the alert stream")
    s.add_argument("--source", required=True)
    s.add_argument("--archive", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--watch", default=None, help="Parquet path for watch alerts (default: console)")
    s.add_argument("--rejects", default=None, help="Parquet path for lines that cannot be decoded, with reasons")
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--fused", action="store_true", help="one query, one source read, both outputs")
    s.add_argument("--timeout", type=float, default=None, help="stop after so many seconds (default: no limit)")
    s.add_argument("--max-file-age", default=NO_AGE_LIMIT, help="skip line files older than this before the newest")
    s.add_argument("--console-rows", type=int, default=20, help="watch rows printed per micro-batch")
    s.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE",
                   help="e.g. startingOffsets=earliest, maxOffsetsPerTrigger=1000000")

    args = p.parse_args(argv)
    lines = MULTI_LINE[args.multi_line]
    spark = build_session(args.master, app_name=f"tremor-{args.job}")
    inputs = getattr(args, "feed", None) or [x for x in (getattr(args, "archive", None) if args.job == "build-catalog"
                                                         else getattr(args, "catalog", None),) if x]
    if inputs:
        size_for(spark, inputs, args.shuffle_partitions)
    if args.job == "build-catalog" and args.archive:
        as_of = _date(args.as_of)
        archive = read_catalog(spark, args.archive, fmt=args.format, multi_line=lines)
        merged = merge.merge_feeds(slice_feeds(archive, args.days, as_of))
        write_catalog(merged, args.out, by_date=args.by_date or args.refreshable, by_cell=args.by_cell,
                      metrics=merge.report_columns()).show(truncate=False)
    elif args.job == "build-catalog":
        build_catalog(spark, args.feed, args.out, fmt=args.format, by_date=args.by_date,
                      multi_line=lines, refreshable=args.refreshable, by_cell=args.by_cell).show(truncate=False)
    elif args.job == "refresh-catalog":
        refresh(spark, args.feed, args.catalog, fmt=args.format, multi_line=lines,
                states_path=args.states).show(truncate=False)
    elif args.job == "daily-states":
        rollup.write_states(spark, args.catalog, args.out)
    elif args.job == "batch-analysis":
        total = run_batch_analysis(spark, args.catalog, args.out, args.format, args.catalog_format,
                                   days=args.days, as_of=_date(args.as_of), multi_line=lines)
        print(f"catalog rows: {total}")
    elif args.job == "hotspots":
        for name, rows in run_hotspots(spark, args.catalog, args.out, args.format, args.catalog_format,
                                       days=args.days, as_of=_date(args.as_of), multi_line=lines).items():
            print(name, [r.asDict() for r in rows])
    elif args.job == "export-views":
        export_views(spark, args.catalog, args.out, args.catalog_format, multi_line=lines, states_path=args.states)
    elif args.job == "replay":
        replay_catalog(spark, args.catalog, args.out, args.catalog_format, multi_line=lines)
    elif args.job == "alerts":
        trigger = {"availableNow": True} if args.available_now else None
        run_alert_stream(spark, args.source, args.archive, args.checkpoint, args.watch, trigger,
                         args.max_files_per_trigger, args.timeout, args.fused, args.max_file_age,
                         dict(o.split("=", 1) for o in args.kafka_option), console_rows=args.console_rows,
                         rejects_path=args.rejects)
    return 0


if __name__ == "__main__":
    sys.exit(main())
