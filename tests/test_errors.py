"""Argument errors are raised eagerly, on the driver, before any job runs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tremor.functions import mag_range
from tremor.operators import union_feeds
from tremor.sinks import read_result, write_result
from tremor.sources import read_catalog


def test_unknown_formats(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        write_result(df, f"{tmp_dir}/x", fmt="orc-ish")
    with pytest.raises(ValueError):
        read_result(spark, f"{tmp_dir}/x", fmt="orc-ish")
    with pytest.raises(ValueError):
        read_catalog(spark, f"{tmp_dir}/x", fmt="orc-ish")


def test_range_labels_must_fit_bounds():
    with pytest.raises(ValueError):
        mag_range(F.col("mag"), bounds=(1.0, 2.0), labels=("a", "b"))


def test_union_needs_a_feed():
    with pytest.raises(ValueError):
        union_feeds([])


def test_csv_result_reads_back_typed(spark, tmp_dir):
    df = spark.createDataFrame([("x", 3, 1.5)], "k string, n bigint, v double")
    write_result(df, f"{tmp_dir}/r", fmt="csv")
    back = read_result(spark, f"{tmp_dir}/r", fmt="csv")
    assert dict(back.dtypes) == {"k": "string", "n": "int", "v": "double"}
    assert tuple(back.first()) == ("x", 3, 1.5)
