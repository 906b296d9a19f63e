"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.session import scratch_path

#: Fixed value: the white space that separates words, as a character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: The same characters, spelled out for ``trim`` and friends.
SPACE_CHARS = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers of this session import this package from where the
    driver did, for a checkout that is not installed. Packages on a cluster's
    own path are found first."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{root}".lstrip(":")


def release_memory() -> None:
    """Give back to the system what this process has freed: its allocators keep
    it, and a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError, TypeError):  # other C libraries than GNU's
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, after which a worker keeps none of the memory that its task has freed."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return released


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale or script of the rest."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


#: The smaller side of a join is broadcast up to so many rows; beyond, the larger side is dealt over salts.
MAX_BROADCAST_ROWS = 1_000_000


def join_spread(rows: DataFrame, side: DataFrame, on: list[str], spread: str, how: str = "inner",
                max_broadcast_rows: int | None = None) -> DataFrame:
    """Join ``rows``, of which any share may have one key, with a smaller ``side``.

    ``side`` is counted and broadcast while it is small; else it is repeated for
    every salt, and the rows of a key are dealt over the salts by their column
    ``spread``. Inner, left and left semi joins."""
    limit = MAX_BROADCAST_ROWS if max_broadcast_rows is None else max_broadcast_rows
    if side.count() <= limit:
        return rows.join(F.broadcast(side), on, how)
    salts = min(64, shuffle_partitions(rows.sparkSession))
    dealt = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return salted.join(dealt, [*on, "_salt"], how).drop("_salt")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared scratch folder, in a folder per
    value of ``partition_by`` if given, and read it back.

    Later jobs (and retries after a lost executor) start from the files; nothing
    is held in executor memory or on one machine's disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
