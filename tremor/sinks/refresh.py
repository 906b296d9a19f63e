"""Refreshing a stored catalog with newly landed feeds, day by day.

Two rows are copies only if their times are equal, so they lie on one UTC day:
new feeds touch the day folders of their own rows and no others. Those days are
merged with what is stored for them and overwritten; all other folders keep
their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.config import DEDUPE_KEYS, DEFAULT_REGION, OTHER_REGION, Region
from tremor.functions.cells import CELL_COLUMN
from tremor.operators.merge import merge_feeds, report_columns
from tremor.sinks.writers import DATE_COLUMN, write_catalog
from tremor.sources.feeds import key_text_column


def touched_days(feeds: Sequence[DataFrame]) -> list:
    """The distinct UTC days of the feeds' rows (``None``: rows without a time)."""
    days = None
    for feed in feeds:
        own = feed.select(F.to_date("time").alias("day")) if "time" in feed.columns else feed.select(
            F.lit(None).cast("date").alias("day"))
        days = own if days is None else days.unionByName(own)
    # One value per day folder that will be written.
    return [r["day"] for r in days.distinct().collect()]


def on_days(days: Sequence) -> Column:
    """Rows in the folders of ``days``: a condition on the layout alone."""
    known = [d for d in days if d is not None]
    inside = F.col(DATE_COLUMN).isin(known) if known else F.lit(False)
    return inside | F.col(DATE_COLUMN).isNull() if None in days else inside


def stored_days(spark: SparkSession, path: str, days: Sequence) -> DataFrame:
    """What a catalog laid out by date holds for ``days``, as a feed to merge.

    Rows without a readable key are told apart by its text where the catalog
    keeps it (``keep_key_text``); where it does not, each stands for itself."""
    stored = spark.read.parquet(path)
    if DATE_COLUMN not in stored.columns:
        raise ValueError(f"{path} is not laid out by date: write it with by_date=True")
    stored = stored.where(on_days(days)).drop(DATE_COLUMN)
    whole = F.to_json(F.struct(*sorted(stored.columns)))
    for key in DEDUPE_KEYS:
        text = key_text_column(key)
        if key in stored.columns and text not in stored.columns:
            stored = stored.withColumn(text, F.when(F.col(key).isNull(), whole))
    return stored.drop("region", CELL_COLUMN)


def _files(spark: SparkSession, path: str, days: Sequence) -> set[str]:
    """Files in the folders of ``days``."""
    rows = spark.read.parquet(path).where(on_days(days)).select(F.col("_metadata.file_path").alias("file")).distinct()
    return {r["file"] for r in rows.collect()}


def _remove(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    location = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(folder))
    location.getFileSystem(sc._jsc.hadoopConfiguration()).delete(location, True)


def refresh_catalog(spark: SparkSession, path: str, feeds: Sequence[DataFrame], newer_first: bool = True,
                    region: Region = DEFAULT_REGION, other: str = OTHER_REGION) -> DataFrame:
    """Merge ``feeds`` (:func:`tremor.sources.read_feed`) into the catalog at
    ``path``, laid out by region and date. Returns the one-row report over the
    days that were written.

    The result equals a rebuild from all feeds ever merged, the newest first
    (``newer_first=False``: stored rows win over new ones). Reads and writes
    only the days of the new rows; feeds without rows change nothing.

    Folders are replaced when all tasks have ended. A folder whose last row moved
    to another region on the same day is removed after that; a refresh that
    stops in between is put right by running it again, since it merges what it
    finds. Run one refresh of a catalog at a time.
    """
    days = touched_days(feeds)
    if not days:
        return spark.read.parquet(path).where(F.lit(False)).agg(*report_columns(region, other))
    before = _files(spark, path, days)
    stored = stored_days(spark, path, days)
    merged = merge_feeds([*feeds, stored] if newer_first else [stored, *feeds], region=region, other=other, keep_key_text=True)
    by_cell = CELL_COLUMN in spark.read.parquet(path).columns
    report = write_catalog(merged, path, by_date=True, by_cell=by_cell, metrics=report_columns(region, other), touched_only=True)
    for folder in {f.rsplit("/", 1)[0] for f in before & _files(spark, path, days)}:
        _remove(spark, folder)
    return report
