"""Order-free sums, and views answered from daily states."""

from __future__ import annotations

import json
import math
import os
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tremor.functions.exact import add_parts, exact_avg, exact_sum, exact_sum_parts, parts_to_double
from tremor.operators import analytics, grid, merge, rollup
from tremor.plans import jobs
from tremor.sinks import refresh_catalog, write_catalog
from tremor.sources.feeds import with_key_text
from tremor.sources.fixture import raw_quakes, read_events

NUMBER = st.one_of(st.floats(-1e7, 1e7), st.floats(-10, 10).map(lambda x: round(x, 1)), st.sampled_from([0.1, 2.675, -0.0, 1e-3]))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(NUMBER, st.none()), min_size=1, max_size=80), st.randoms())
def test_sums_are_bit_equal_in_any_order(spark, values, random):
    # Units of 2**-60: what is finer is rounded by itself.
    exact = sum((Fraction(round(Fraction(v) * 2**60), 2**60) for v in values if v is not None), Fraction(0))
    known = [v for v in values if v is not None]
    got = set()
    for parts in (1, 3, 7):
        random.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        row = df.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()
        states = df.groupBy(F.spark_partition_id()).agg(*(c.alias(k) for k, c in exact_sum_parts(F.col("v")).items()))
        added = states.agg(parts_to_double(**add_parts(F.col("high"), F.col("low"), F.col("other")))).first()[0]
        got.add((row[0], row[1], added))
    assert len(got) == 1
    total, average, added = got.pop()
    assert total == added and (total is None) == (not known)
    if known:
        assert abs(Fraction(total) - exact) <= Fraction(math.ulp(total)) and average == total / len(known)


def test_large_and_infinite_values_are_added_beside(spark):
    df = spark.createDataFrame([(1e300,), (0.5,), (1e300,), (None,)], "v double")
    assert df.agg(exact_sum(F.col("v"))).first()[0] == 2e300
    assert spark.createDataFrame([(math.inf,), (0.5,)], "v double").agg(exact_avg(F.col("v"))).first()[0] == math.inf


def test_averages_do_not_move_with_partitions(spark, catalog_small):
    tables = [analytics.regional_stats, analytics.regional_avg_mag, analytics.summary,
              lambda c: analytics.profile_tables(analytics.range_region_profile(c))["regional_stats"]]
    rows = [[t(catalog_small.repartition(n, F.col("event_id") * n)).first() for t in tables] for n in (1, 5, 13)]
    assert rows[0] == rows[1] == rows[2]
    assert rows[0][0]["avg_mag"] == rows[0][1]["avg_mag"] == rows[0][3]["avg_mag"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def assert_views_equal(states, catalog):
    cells = states[rollup.CELLS]
    assert rollup.summary(cells).schema == analytics.summary(catalog).schema
    assert rollup.summary(cells).first() == analytics.summary(catalog).first()
    assert rollup.regional_stats(cells).first() == analytics.regional_stats(catalog).first()
    assert rollup.counts_by(cells, "mag_range").collect() == analytics.mag_range_counts(catalog).collect()
    assert rollup.counts_by(cells, "region").collect() == analytics.region_counts(catalog).collect()
    assert rollup.top_places(states[rollup.PLACES]).collect() == analytics.top_places(catalog).collect()
    assert rollup.hotspots_top(cells).collect() == grid.hotspots_top(catalog).collect()
    for region in (None, "Pakistan"):
        assert rows_of(rollup.hotspots(cells, region)) == rows_of(grid.hotspots(catalog, region, sort=False))


def stored(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_states_follow_a_refresh_day_by_day(spark, tmp_dir):
    raw = with_key_text(raw_quakes(read_events(spark, SF_SMALL)))
    raw = raw.withColumn("time", F.when(F.col("event_id") % 41 != 0, F.col("time")))  # some without a time
    late = (F.col("event_id") % 4 == 0) & (F.coalesce(F.col("time") >= F.lit("2024-01-25").cast("timestamp_ntz"), F.lit(True)))
    write_catalog(merge.merge_feeds([raw.where(~late)], keep_key_text=True), f"{tmp_dir}/cat", by_date=True)
    rollup.write_states(spark, f"{tmp_dir}/cat", f"{tmp_dir}/states")
    assert_views_equal(rollup.read_states(spark, f"{tmp_dir}/states"), spark.read.parquet(f"{tmp_dir}/cat"))
    before, feeds = stored(f"{tmp_dir}/states"), [raw.where(late)]
    refresh_catalog(spark, f"{tmp_dir}/cat", feeds)
    rollup.refresh_states(spark, f"{tmp_dir}/cat", f"{tmp_dir}/states", feeds)
    assert_views_equal(rollup.read_states(spark, f"{tmp_dir}/states"), spark.read.parquet(f"{tmp_dir}/cat"))
    after = stored(f"{tmp_dir}/states")
    old_days = {f for f in before if "event_date=2024-01-1" in f}
    assert old_days and all(after[f] == before[f] for f in old_days)
    assert not any(f in after for f in before if "event_date=2024-01-2" in f and f.split("event_date=")[1][:10] >= "2024-01-25")


def test_endpoint_files_from_states(spark, catalog_small, tmp_dir):
    write_catalog(catalog_small, f"{tmp_dir}/cat", by_date=True)
    assert jobs.main(["daily-states", "--catalog", f"{tmp_dir}/cat", "--out", f"{tmp_dir}/states"]) == 0
    jobs.export_views(spark, f"{tmp_dir}/cat", f"{tmp_dir}/direct")
    jobs.main(["export-views", "--catalog", f"{tmp_dir}/cat", "--out", f"{tmp_dir}/added", "--states", f"{tmp_dir}/states"])
    for view in ("summary", "hotspots"):
        direct, added = (sorted(json.dumps(json.loads(r.value)) for r in spark.read.text(f"{tmp_dir}/{k}/{view}").collect())
                         for k in ("direct", "added"))
        assert direct == added and direct


def test_states_of_an_empty_catalog(spark, catalog_small):
    cells = rollup.cell_states(catalog_small.where(F.lit(False)))
    assert rollup.summary(cells).first() == analytics.summary(catalog_small.where(F.lit(False))).first()
    assert rollup.regional_stats(cells).first() == analytics.regional_stats(catalog_small.where(F.lit(False))).first()
