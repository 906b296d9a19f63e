"""Merging overlapping feeds into one catalog.

``union → keep-first dedupe → region tag``. "First" means: the row of the
feed listed first wins; within a feed, rows are ordered by their remaining
columns so the choice never depends on file splits or task order.

Scale: the dedupe is ``row_number() = 1`` over the key. Spark plans it with a
partial ``WindowGroupLimit`` before the shuffle, so each map task forwards at
most one row per key; a hot key (e.g. rows missing both time and magnitude)
costs one row per task on the wire, not its full size.

Whole rows cross the shuffle once. Finding the winners on a narrow projection
first would not save that: the winners would then have to be joined back to
the full rows, a second full shuffle (or a broadcast whose size the data
decides), so the single window shuffle is the cheaper plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.config import DEDUPE_KEYS, DEFAULT_REGION, OTHER_REGION, Region
from tremor.operators.regions import assign_region
from tremor.sources.feeds import key_text_column

FEED_COLUMN = "feed"

_ORDERABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def union_feeds(feeds: Sequence[DataFrame], feed_column: str = FEED_COLUMN) -> DataFrame:
    """Stack feeds by column name; a column missing from a feed is null there.
    Each row is tagged with its feed's position (0 = highest priority)."""
    if not feeds:
        raise ValueError("union_feeds needs at least one feed")
    tagged = [f.withColumn(feed_column, F.lit(i)) for i, f in enumerate(feeds)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def dedupe_keep_first(
    df: DataFrame,
    keys: Sequence[str] = DEDUPE_KEYS,
    feed_column: str = FEED_COLUMN,
    tiebreak: Sequence[str] | None = None,
    keep_key_text: bool = False,
) -> DataFrame:
    """One row per key (nulls equal each other), the first by
    ``(feed_column, *tiebreak)``; keys absent from ``df`` are ignored, and with
    no key left whole-row duplicates are removed instead.

    Where a key could not be read, its text as read decides
    (:func:`tremor.sources.feeds.with_key_text`); keys that were empty in the
    feed equal each other. Those text columns are dropped unless ``keep_key_text``."""
    texts = [key_text_column(k) for k in keys if key_text_column(k) in df.columns]
    present = [k for k in keys if k in df.columns]
    if not present:
        return dedupe_full_row(df, exclude=(feed_column, *(() if keep_key_text else texts)))
    if tiebreak is None:
        tiebreak = [
            f.name
            for f in df.schema.fields
            if f.name not in present and f.name not in texts and f.name != feed_column and isinstance(f.dataType, _ORDERABLE)
        ]
    order = ([F.col(feed_column).asc()] if feed_column in df.columns else []) + [
        F.col(c).asc_nulls_first() for c in tiebreak
    ]
    w = Window.partitionBy(*present, *texts).orderBy(*order)
    first = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1)
    return first.drop("_rank") if keep_key_text else first.drop("_rank", *texts)


def dedupe_full_row(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Drop rows equal on every column (``exclude`` columns are not compared
    and are dropped). A hash aggregate with map-side combine."""
    cols = [c for c in df.columns if c not in exclude]
    return df.select(*cols).dropDuplicates()


def merge_feeds(
    feeds: Sequence[DataFrame],
    keys: Sequence[str] = DEDUPE_KEYS,
    region: Region = DEFAULT_REGION,
    other: str = OTHER_REGION,
    keep_feed: bool = False,
    keep_key_text: bool = False,
) -> DataFrame:
    """Union, keep-first dedupe on ``keys``, then region tagging. ``keep_key_text``
    keeps the text of unreadable keys, for a catalog that is to be refreshed."""
    merged = dedupe_keep_first(union_feeds(feeds), keys, keep_key_text=keep_key_text)
    tagged = assign_region(merged, region, other)
    return tagged if keep_feed or FEED_COLUMN not in tagged.columns else tagged.drop(FEED_COLUMN)


def report_columns(region: Region = DEFAULT_REGION, other: str = OTHER_REGION) -> list[Column]:
    """The aggregates of :func:`merge_report`."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("region") == F.lit(region.name)).alias(f"{region.name.lower()}_count"),
        F.count_if(F.col("region") == F.lit(other)).alias(f"{other.lower()}_count"),
        F.count_if(F.col("time").isNull() | F.col("mag").isNull()).alias("null_key_count"),
    ]


def merge_report(df: DataFrame, region: Region = DEFAULT_REGION, other: str = OTHER_REGION) -> DataFrame:
    """One row: ``total``, the count per region label, and the rows whose time
    or magnitude is missing or could not be read (``null_key_count``)."""
    return df.agg(*report_columns(region, other))
