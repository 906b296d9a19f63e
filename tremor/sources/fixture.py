"""Test adapter: derive seismic catalog rows from the driver's ``events`` table.

The test tables carry no seismic data, so a deterministic projection maps each
``events`` row to one catalog row (one row in, one row out; no shuffle). It
injects null latitudes, magnitudes and places, half-way coordinates for the
rounding modes, magnitudes on every ladder boundary and stations inside and
around the regional box. The same mapping is written as SQL in
``tremor.plans.oracle`` for the cross-engine check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.config import DEFAULT_REGION, GLOBAL_FEED_MIN_MAG, REGIONAL_FEED_MIN_MAG
from tremor.functions.classify import region_label
from tremor.sources.feeds import feed_slice


# Columns of the driver's ``events`` table, given up front so no job is spent
# inferring the schema from Parquet footers.
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _centi(uid: Column, on_box: tuple[int, int, int], off_box: tuple[int, int, int], jitter: Column) -> Column:
    base_in, mul_in, span_in = on_box
    base_out, mul_out, span_out = off_box
    near = F.lit(base_in) + (uid * F.lit(mul_in)) % F.lit(span_in)
    far = F.lit(base_out) + (uid * F.lit(mul_out)) % F.lit(span_out)
    return F.when(uid % 5 == 0, near).otherwise(far) + jitter


def raw_quakes(events: DataFrame) -> DataFrame:
    """Catalog rows without ``region`` (``event_id`` kept as a pass-through id)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    lat_centi = _centi(uid, (2250, 53, 1500), (-6000, 4703, 12000),
                       F.when(uid % 2 == 1, (eid % 3) * 5).otherwise(F.lit(0)))
    lon_centi = _centi(uid, (5950, 71, 1800), (-18000, 8311, 36000),
                       F.when(eid % 17 == 0, F.lit(30)).otherwise(F.lit(0)))
    null_double = F.lit(None).cast("double")
    place = F.concat(
        (F.lit(5) * (eid % 4)).cast("string"), F.lit(" km S of Station "),
        uid.cast("string"), F.lit(", Zone "), (uid % 7).cast("string"),
    )
    return events.select(
        eid.alias("event_id"),
        F.col("ts").alias("time"),
        F.when(eid % 101 == 7, null_double).otherwise(lat_centi.cast("double") / 100).alias("latitude"),
        (lon_centi.cast("double") / 100).alias("longitude"),
        F.col("value").alias("depth"),
        F.when(eid % 97 == 13, null_double).otherwise(((eid * 37) % 95).cast("double") / 10).alias("mag"),
        F.when(eid % 89 == 5, F.lit(None).cast("string")).otherwise(place).alias("place"),
        F.col("event_type").alias("type"),
    )


def quakes(events: DataFrame) -> DataFrame:
    """The fixture catalog: :func:`raw_quakes` plus the derived ``region``."""
    raw = raw_quakes(events)
    return raw.withColumn("region", region_label(F.col("latitude"), F.col("longitude")))


def load_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quakes(read_events(spark, sf_dir))


def fixture_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping feeds, as two feed requests would return them:
    global (``mag >= 2.5``) and regional (``mag >= 2.0`` inside the box).
    Regional ``place`` text is prefixed so a keep-first merge is visible."""
    raw = raw_quakes(read_events(spark, sf_dir))
    global_feed = feed_slice(raw, min_mag=GLOBAL_FEED_MIN_MAG)
    regional_feed = feed_slice(raw, min_mag=REGIONAL_FEED_MIN_MAG, region=DEFAULT_REGION)
    regional_feed = regional_feed.withColumn("place", F.concat(F.lit("R "), F.col("place")))
    return global_feed, regional_feed


__all__ = ["fixture_feeds", "load_catalog", "quakes", "raw_quakes", "read_events"]
