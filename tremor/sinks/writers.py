"""Writers: result tables, the catalog, and replay line files.

All writes go through Spark's commit protocol (task output is promoted only
when the job commits), so a lost executor leads to a retried task, never to a
partial or duplicated file set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tremor.functions.cells import CELL_COLUMN, cell_code
from tremor.sources.lines import encode_lines


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write one result table (``parquet`` or header ``csv``).

    CSV keeps blanks at the ends of a text, doubles quotes inside quoted fields
    and leaves line breaks inside them; :func:`tremor.sources.read_catalog` and
    :func:`read_result` read them back. CSV cannot tell an empty text from a
    missing one: both read back as null.
    """
    writer = df.write.mode(mode)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        # Spark's default CSV timestamp text keeps milliseconds only; write all six digits.
        (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
            .csv(path)
        )
    else:
        raise ValueError(f"unsupported result format {fmt!r}")


def read_result(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Read back a table written by :func:`write_result` (small result tables only
    when ``fmt='csv'``, whose column types are inferred)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        return (spark.read.option("header", True).option("inferSchema", True).option("escape", '"')
                .option("multiLine", True).csv(path))
    raise ValueError(f"unsupported result format {fmt!r}")


DATE_COLUMN = "event_date"


def write_catalog(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    mode: str = "overwrite",
    by_date: bool = False,
    metrics: Sequence[Column] = (),
    touched_only: bool = False,
    by_cell: bool = False,
) -> DataFrame | None:
    """Write the catalog as Parquet laid out by ``partition_by``.

    Without dates, no repartition on the partition column first: with two region values that
    would funnel the whole catalog through two tasks. Each task writes one file
    per region it holds instead, and readers filtering on region skip the
    other folder entirely.

    ``by_date=True`` adds ``event_date`` (the UTC date of ``time``) as a further
    partition column, so time-window reads (:func:`tremor.sources.feed_slice`)
    skip whole days; rows without a time go to the null-date folder. Rows are
    then rebalanced by folder: a folder's rows meet in few files, and adaptive
    execution splits folders above its advisory size over several tasks.

    ``by_cell=True`` adds ``cell`` (:mod:`tremor.functions.cells`) and sorts each
    file by it, so that a box read by :func:`tremor.sources.feed_slice` skips the
    row groups and pages that hold none of its cells. Without dates the rows are
    range-partitioned by folder and cell, a cell of many rows over several
    tasks; with dates each day's files are sorted by cell.

    ``metrics`` (aggregates) are taken while the rows are written, in the writing
    stage, whose tasks count once however often they are tried; returned is
    their one-row table. ``touched_only`` overwrites only the folders that get
    rows and leaves the others and their files alone.
    """
    columns = list(partition_by)
    if by_date:
        df = df.withColumn(DATE_COLUMN, F.to_date(F.col("time")))
        columns.append(DATE_COLUMN)
    if by_cell:
        df = df.withColumn(CELL_COLUMN, cell_code(F.col("latitude"), F.col("longitude")))
    if by_date:
        df = df.hint("rebalance", *columns)
    elif by_cell:
        df = df.repartitionByRange(*columns, CELL_COLUMN, F.xxhash64("time", "mag"))
    if by_cell:
        df = df.sortWithinPartitions(*columns, CELL_COLUMN)
    observation = Observation("catalog-write") if metrics else None
    if observation:
        df = df.observe(observation, *metrics)
    writer = df.write.mode(mode)
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)
    if observation:
        spark, schema = df.sparkSession, df.limit(0).agg(*metrics).schema
        return spark.createDataFrame([tuple(observation.get[f.name] for f in schema.fields)], schema)
    return None


def write_lines(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Write the catalog as comma-separated event lines (one text file per task)."""
    writer = encode_lines(df).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
