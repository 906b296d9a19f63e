"""Event feeds: reading landed feed files, request-style slicing, emptiness checks.

The network download itself is not part of this library: feeds are landed as
files (CSV or Parquet) by whatever fetches them, and read here in parallel.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.config import DEDUPE_KEYS, FEED_DAYS, Region
from tremor.functions.cells import CELL_COLUMN, in_cells
from tremor.functions.classify import in_region
from tremor.sources.catalog import normalize, read_catalog
from tremor.sources.csv_files import read_csv_text


class EmptyFeedError(RuntimeError):
    """A feed that must hold rows holds none."""


def require_non_empty(df: DataFrame, label: str) -> DataFrame:
    """Fail fast on an empty feed. Runs one ``LIMIT 1`` job, not a count."""
    if df.isEmpty():
        raise EmptyFeedError(f"feed {label!r} returned 0 rows")
    return df


def key_text_column(key: str) -> str:
    """Column that holds a key's text as it stood in the feed."""
    return f"{key}_as_read"


def with_key_text(raw: DataFrame) -> DataFrame:
    """Normalize a raw feed, keeping the text of unreadable merge keys: two
    events whose times (or magnitudes) cannot be read are still two events."""
    texts = {key_text_column(k): F.col(k).cast("string") for k in DEDUPE_KEYS if k in raw.columns}
    typed = normalize(raw.withColumns(texts) if texts else raw)
    unread = {key_text_column(k): F.when(F.col(k).isNull(), F.col(key_text_column(k))) for k in DEDUPE_KEYS
              if key_text_column(k) in typed.columns}
    return typed.withColumns(unread) if unread else typed


def read_feed(spark: SparkSession, path: str, label: str, fmt: str = "csv", check: bool = True,
              multi_line: bool | None = None) -> DataFrame:
    """Read one landed feed (raw columns, no ``region``), normalized; the text of
    unreadable ``time`` and ``mag`` values stays beside them for the merge. A
    feed may be a folder or a glob of files with different headers."""
    if fmt == "csv":
        df = with_key_text(read_csv_text(spark, path, multi_line))
    else:
        df = read_catalog(spark, path, fmt=fmt)
    df = df.drop("region")
    return require_non_empty(df, label) if check else df


def trailing_range(days: int = FEED_DAYS, as_of: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """``(as_of - days, as_of)`` in UTC dates; ``as_of`` defaults to today (UTC)."""
    end = as_of if as_of is not None else dt.datetime.now(dt.timezone.utc).date()
    return end - dt.timedelta(days=days), end


def _bound(value: dt.date | dt.datetime | str):
    """A time bound as a TIMESTAMP_NTZ literal (dates mean midnight UTC)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def feed_slice(
    df: DataFrame,
    start: dt.date | dt.datetime | str | None = None,
    end: dt.date | dt.datetime | str | None = None,
    min_mag: float | None = None,
    region: Region | None = None,
) -> DataFrame:
    """Rows a feed request would return: ``start <= time <= end``,
    ``mag >= min_mag`` and, when given, inside ``region``'s box.

    One conjunctive filter. The time bounds reach the Parquet scan as pushed
    filters (row-group statistics skip whole groups of a time-clustered
    catalog), and on a catalog laid out by date (``write_catalog(by_date=True)``)
    they are also applied to ``event_date``, which prunes whole day folders.
    On a catalog sorted by cell (``by_cell=True``) the box becomes a few ranges of
    cells that reach the scan; the exact box test follows.
    The magnitude and box tests run right after the scan in the same codegen
    stage (after :func:`normalize` they read NaN-cleaned values, which a
    Parquet filter cannot express).
    """
    cond = F.lit(True)
    dated = "event_date" in df.columns
    if start is not None:
        cond = cond & (F.col("time") >= _bound(start))
        if dated:
            cond = cond & (F.col("event_date") >= F.to_date(_bound(start)))
    if end is not None:
        cond = cond & (F.col("time") <= _bound(end))
        if dated:
            cond = cond & (F.col("event_date") <= F.to_date(_bound(end)))
    if min_mag is not None:
        cond = cond & (F.col("mag") >= F.lit(float(min_mag)))
    if region is not None:
        if CELL_COLUMN in df.columns:
            cond = cond & in_cells(F.col(CELL_COLUMN), region)
        cond = cond & in_region(F.col("latitude"), F.col("longitude"), region)
    return df.filter(cond)


def trailing_window(df: DataFrame, days: int = FEED_DAYS, as_of: dt.date | None = None) -> DataFrame:
    """Rows in the trailing ``days`` ending at ``as_of`` (both dates at midnight UTC)."""
    start, end = trailing_range(days, as_of)
    return feed_slice(df, start, end)
