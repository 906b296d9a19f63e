"""Reference SQL for every registered query, runnable by DuckDB over the raw
test tables (``events`` is a pre-registered view). Column names equal the
Spark query's. Written independently of the Spark code path, from the
semantics alone, so the two engines check each other.

Conventions: explicit ``NULLS FIRST/LAST`` wherever order matters (the engines'
defaults differ); ``||`` rather than ``concat`` for text that can be null;
``+ 0.0`` after rounding so a negative zero compares equal to zero.
"""

from __future__ import annotations

# The events → catalog mapping (same rule as ``tremor.sources.fixture``).
_BASE = """
WITH raw AS (
  SELECT event_id, ts AS time,
    CASE WHEN event_id % 101 = 7 THEN NULL ELSE CAST(
      (CASE WHEN user_id % 5 = 0 THEN 2250 + (user_id * 53) % 1500
            ELSE -6000 + (user_id * 4703) % 12000 END)
      + (CASE WHEN user_id % 2 = 1 THEN (event_id % 3) * 5 ELSE 0 END) AS DOUBLE) / 100
    END AS latitude,
    CAST(
      (CASE WHEN user_id % 5 = 0 THEN 5950 + (user_id * 71) % 1800
            ELSE -18000 + (user_id * 8311) % 36000 END)
      + (CASE WHEN event_id % 17 = 0 THEN 30 ELSE 0 END) AS DOUBLE) / 100 AS longitude,
    value AS depth,
    CASE WHEN event_id % 97 = 13 THEN NULL
         ELSE CAST((event_id * 37) % 95 AS DOUBLE) / 10 END AS mag,
    CASE WHEN event_id % 89 = 5 THEN NULL ELSE concat(
      CAST(5 * (event_id % 4) AS VARCHAR(10)), ' km S of Station ',
      CAST(user_id AS VARCHAR(10)), ', Zone ', CAST(user_id % 7 AS VARCHAR(10)))
    END AS place,
    event_type AS type
  FROM events),
quakes AS (
  SELECT *, CASE WHEN latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77
                 THEN 'Pakistan' ELSE 'Global' END AS region FROM raw),
feeds AS (
  SELECT event_id, time, latitude, longitude, depth, mag, place, type, 0 AS feed
  FROM raw WHERE mag >= 2.5
  UNION ALL
  SELECT event_id, time, latitude, longitude, depth, mag, 'R ' || place AS place, type, 1 AS feed
  FROM raw WHERE mag >= 2.0 AND latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77),
merged AS (
  SELECT event_id, time, latitude, longitude, depth, mag, place, type,
         CASE WHEN latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77
              THEN 'Pakistan' ELSE 'Global' END AS region
  FROM (SELECT *, row_number() OVER (
          PARTITION BY time, mag
          ORDER BY feed, event_id NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST,
                   depth NULLS FIRST, place NULLS FIRST, type NULLS FIRST) AS rn
        FROM feeds) WHERE rn = 1)
"""

_ISO = """CASE WHEN strftime(time, '%f') = '000000'
     THEN strftime(time, '%Y-%m-%dT%H:%M:%S') || '+00:00'
     ELSE strftime(time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END"""

_ALERT = """CASE WHEN mag > 6 THEN 'CRITICAL' WHEN mag > 5 THEN 'HIGH'
     WHEN mag > 4 THEN 'MEDIUM' ELSE 'LOW' END"""

_STREAM_ALERT = """CASE WHEN mag > 6 THEN 'CRITICAL !!' WHEN mag > 5 THEN 'HIGH'
     WHEN mag > 4 THEN 'MEDIUM' ELSE 'LOW' END"""

_RECORD = f"""{_ISO} AS time, latitude, longitude, depth, mag, place, region,
  {_ALERT} AS alert_level"""

_NEWEST_FIRST = """time DESC NULLS LAST, latitude ASC NULLS FIRST, longitude ASC NULLS FIRST,
  depth ASC NULLS FIRST, mag ASC NULLS FIRST, place ASC NULLS FIRST"""

_RISK = """CASE WHEN count(*) > 50 THEN 'CRITICAL' WHEN count(*) > 30 THEN 'HIGH'
     WHEN count(*) > 10 THEN 'MEDIUM' ELSE 'LOW' END"""

_LINE_PLACE = "trim(replace(coalesce(place, ''), ',', ' '))"
_LINE_TIME = "strftime(time, '%Y-%m-%dT%H:%M:%S.%fZ')"


# Event lines: the catalog, and for every fiftieth event the messy lines that still hold a magnitude.
_LINES = f"""lines AS (
  SELECT time, latitude, longitude, depth, mag, {_LINE_PLACE} AS place, type, region, {_LINE_TIME} AS time_raw FROM quakes
  UNION ALL
  SELECT m.* FROM (SELECT event_id FROM events WHERE event_id % 50 = 0) e CROSS JOIN (VALUES
    (CAST(NULL AS TIMESTAMP), 1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE, 7.5::DOUBLE, 'Some Place', 'quake', 'Global', 'bad clock'),
    (TIMESTAMP '2024-02-03 04:05:06', 1.5, 2.5, NULL, 6.5, NULL, NULL, NULL, '2024-02-03T04:05:06Z'),
    (TIMESTAMP '2024-02-03 04:05:06', 91.0, 181.0, NULL, 5.5, 'A', 'B', 'Pakistan', '2024-02-03 04:05:06'),
    (NULL, 1.0, 2.0, 3.0, 8.0, 'P', '', '', '')) m)"""

_ODD_PLACE = """CASE event_id % 13 WHEN 0 THEN '5 km "N", ' || place WHEN 1 THEN '  ' || place || '  '
  WHEN 2 THEN place || chr(10) || 'second line' WHEN 3 THEN '""' || place || '"'
  WHEN 4 THEN place || chr(13) || chr(10) || ', end' ELSE place END"""

_MESSY = """messy AS (
  SELECT event_id, time, latitude, longitude, CASE WHEN feed = 0 THEN depth END AS depth, mag, place, type, feed,
         CASE WHEN feed = 1 THEN event_id % 10 END AS felt FROM feeds
  UNION ALL
  SELECT event_id, CASE WHEN event_id % 2 = 1 THEN time END, latitude, longitude, depth, mag, place, type, 2, NULL
  FROM raw WHERE event_id % 97 = 13),
messy_merged AS (
  SELECT event_id, time, latitude, longitude, depth, mag, place, type, felt,
         CASE WHEN latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77
              THEN 'Pakistan' ELSE 'Global' END AS region
  FROM (SELECT *, row_number() OVER (PARTITION BY time, mag ORDER BY feed, event_id) AS rn FROM messy) WHERE rn = 1)"""


# A catalog into which the late rows of every fourth event were merged afterwards.
_REFRESHED = """refreshed AS (
  SELECT *, CASE WHEN latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77 THEN 'Pakistan' ELSE 'Global' END AS region
  FROM (SELECT *, row_number() OVER (PARTITION BY time, mag ORDER BY CASE
          WHEN event_id % 4 = 0 AND time >= TIMESTAMP '2024-01-20 00:00:00' THEN 0 ELSE 1 END, event_id) AS rn FROM raw)
  WHERE rn = 1)"""


# Of the same lines those without a readable magnitude.
_REJECTED = f"""rejected AS (
  SELECT 'no magnitude' AS reason, 8 AS n_fields, {_LINE_TIME} AS time_raw FROM quakes WHERE mag IS NULL
  UNION ALL
  SELECT m.* FROM (SELECT event_id FROM events WHERE event_id % 50 = 0) e CROSS JOIN (VALUES
    ('empty line', 1, ''), ('too few fields', 2, 'abc'), ('unreadable magnitude', 8, '2024-02-03T04:05:06Z')) m)"""


def _hotspots(where: str = "", order_limit: str = "") -> str:
    return f"""{_BASE}
SELECT round(latitude, 1) + 0.0 AS lat_grid, round(longitude, 1) + 0.0 AS lon_grid,
       count(*) AS count, {_RISK} AS risk_level
FROM quakes {where}
GROUP BY 1, 2 {order_limit}"""


_PREVIEW_ORDER = "ORDER BY count DESC, lat_grid ASC NULLS FIRST, lon_grid ASC NULLS FIRST"

ORACLE_SQL: dict[str, str] = {
    "catalog_count": f"{_BASE} SELECT count(*) AS count FROM quakes",
    "mag_range_counts": f"""{_BASE}
SELECT CASE WHEN mag < 2 THEN 'Minor' WHEN mag >= 2 AND mag < 4 THEN 'Light'
            WHEN mag >= 4 AND mag < 6 THEN 'Moderate' WHEN mag >= 6 AND mag <= 8 THEN 'Strong'
            ELSE 'Major' END AS mag_range, count(*) AS count
FROM quakes GROUP BY 1""",
    "region_counts": f"{_BASE} SELECT region, count(*) AS count FROM quakes GROUP BY region",
    "top_places": f"""{_BASE}
SELECT place, count(*) AS count FROM quakes GROUP BY place
ORDER BY count DESC, place ASC NULLS FIRST LIMIT 10""",
    "regional_stats": f"""{_BASE}
SELECT count(*) AS total, round(avg(mag), 6) AS avg_mag, max(mag) AS max_mag, min(mag) AS min_mag
FROM quakes WHERE region = 'Pakistan'""",
    "regional_avg_mag": f"""{_BASE}
SELECT round(avg(mag), 6) AS avg_mag FROM quakes WHERE region = 'Pakistan'""",
    "summary": f"""{_BASE}
SELECT count(*) AS total_earthquakes,
       count(*) FILTER (WHERE region = 'Pakistan') AS pakistan_count,
       count(*) FILTER (WHERE mag > 6) AS critical_count,
       count(*) FILTER (WHERE mag > 5 AND mag <= 6) AS high_count,
       coalesce(round_even(avg(mag), 2), 0.0) AS average_magnitude,
       coalesce(round_even(max(mag), 2), 0.0) AS max_magnitude
FROM quakes""",
    "classify_mag_range": f"""{_BASE}
SELECT event_id, CASE WHEN mag < 2 THEN 'Minor' WHEN mag < 4 THEN 'Light'
  WHEN mag < 6 THEN 'Moderate' WHEN mag <= 8 THEN 'Strong' ELSE 'Major' END AS mag_range
FROM quakes""",
    "classify_alert": f"{_BASE} SELECT event_id, {_ALERT} AS alert_level FROM quakes",
    "classify_stream_alert": f"""{_BASE}
SELECT event_id, {_STREAM_ALERT} AS alert_level, region = 'Pakistan' AS is_pakistan FROM quakes""",
    "assign_region": f"{_BASE} SELECT event_id, region FROM quakes",
    "normalize_catalog": f"""{_BASE}
SELECT event_id,
       CASE WHEN event_id % 61 = 3 OR event_id % 67 IN (4, 5, 6) THEN NULL
            WHEN event_id % 67 IN (1, 2) THEN time - INTERVAL 5 HOUR
            WHEN event_id % 67 = 3 THEN time + INTERVAL 5 HOUR ELSE time END AS time,
       latitude, longitude,
       CASE WHEN event_id % 59 = 2 THEN NULL ELSE depth END AS depth,
       CASE WHEN event_id % 53 BETWEEN 11 AND 15 THEN NULL ELSE mag END AS mag,
       place, region, CAST(NULL AS VARCHAR) AS type
FROM quakes""",
    "grid_half_up": f"""{_BASE}
SELECT event_id, round(latitude, 1) + 0.0 AS lat_grid, round(longitude, 1) + 0.0 AS lon_grid FROM quakes""",
    "grid_half_even": f"""{_BASE}
SELECT event_id, round_even(latitude, 1) + 0.0 AS lat_grid, round_even(longitude, 1) + 0.0 AS lon_grid
FROM quakes""",
    "hotspots": _hotspots(),
    "hotspots_regional": _hotspots("WHERE region = 'Pakistan'"),
    "hotspots_preview": _hotspots("", f"{_PREVIEW_ORDER} LIMIT 10"),
    "hotspots_regional_preview": _hotspots("WHERE region = 'Pakistan'", f"{_PREVIEW_ORDER} LIMIT 5"),
    "hotspots_top": f"""{_BASE}
SELECT round_even(latitude, 1) + 0.0 AS latitude, round_even(longitude, 1) + 0.0 AS longitude,
       count(*) AS count
FROM quakes WHERE latitude IS NOT NULL AND longitude IS NOT NULL
GROUP BY 1, 2
ORDER BY count DESC, latitude ASC, longitude ASC LIMIT 20""",
    "feed_slice_global": f"""{_BASE}
SELECT * FROM raw
WHERE time >= TIMESTAMP '2023-12-21 00:00:00' AND time <= TIMESTAMP '2024-01-20 00:00:00'
  AND mag >= 2.5""",
    "feed_slice_regional": f"""{_BASE}
SELECT * FROM raw
WHERE time >= TIMESTAMP '2023-12-21 00:00:00' AND time <= TIMESTAMP '2024-01-20 00:00:00'
  AND mag >= 2.0 AND latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77""",
    "feed_slice_by_cell": f"""{_BASE}
SELECT * FROM raw
WHERE time >= TIMESTAMP '2023-12-21 00:00:00' AND time <= TIMESTAMP '2024-01-20 00:00:00'
  AND mag >= 2.0 AND latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77""",
    "trailing_days": f"""{_BASE}
SELECT * FROM quakes
WHERE time >= TIMESTAMP '2024-01-08 00:00:00' AND time <= TIMESTAMP '2024-01-15 00:00:00'""",
    "union_feeds": f"{_BASE} SELECT * FROM feeds",
    "merge_feeds": f"{_BASE} SELECT * FROM merged",
    "merge_report": f"""{_BASE}
SELECT count(*) AS total, count(*) FILTER (WHERE region = 'Pakistan') AS pakistan_count,
       count(*) FILTER (WHERE region = 'Global') AS global_count,
       count(*) FILTER (WHERE time IS NULL OR mag IS NULL) AS null_key_count
FROM merged""",
    "dedupe_full_row": f"""{_BASE}
SELECT DISTINCT event_id, latitude, longitude, depth, place, type FROM (
  SELECT event_id, latitude, longitude, depth, place, type FROM raw WHERE mag >= 2.5
  UNION ALL
  SELECT event_id, latitude, longitude, depth, place, type FROM raw
  WHERE mag >= 2.0 AND latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77)""",
    "event_records": f"{_BASE} SELECT {_RECORD} FROM quakes",
    "event_json": f"{_BASE} SELECT {_RECORD} FROM quakes",
    "regional_events": f"""{_BASE}
SELECT {_RECORD} FROM quakes WHERE region = 'Pakistan' ORDER BY {_NEWEST_FIRST}""",
    "recent_events": f"""{_BASE}
SELECT {_RECORD} FROM (SELECT * FROM quakes ORDER BY {_NEWEST_FIRST} LIMIT 100)""",
    "encode_lines": f"""{_BASE}
SELECT {_LINE_TIME} AS time, latitude, longitude, depth, mag,
       {_LINE_PLACE} AS place, type, region, 8 AS n_fields
FROM quakes""",
    "decode_lines": f"{_BASE}, {_LINES} SELECT * FROM lines WHERE mag IS NOT NULL",
    "rejected_lines": f"{_BASE}, {_REJECTED} SELECT * FROM rejected",
    "stream_rejected_lines": f"{_BASE}, {_REJECTED} SELECT reason, count(*) AS count FROM rejected GROUP BY reason",
    "catalog_refresh": f"""{_BASE},
versions AS (
  SELECT event_id, time, latitude + event_id % 5 AS latitude, longitude, depth + 1 AS depth, mag, place, type, 0 AS version
  FROM raw WHERE event_id % 2 = 0 AND time >= TIMESTAMP '2024-01-20 00:00:00'
  UNION ALL
  SELECT event_id, time, latitude, longitude, depth, mag, place, type, 1 FROM raw WHERE event_id % 3 <> 0)
SELECT event_id, time, latitude, longitude, depth, mag, place, type,
       CASE WHEN latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77 THEN 'Pakistan' ELSE 'Global' END AS region,
       CAST(time AS DATE) AS event_date
FROM (SELECT *, row_number() OVER (PARTITION BY time, mag ORDER BY version, event_id) AS rn FROM versions) WHERE rn = 1""",
    "states_summary": f"""{_BASE}, {_REFRESHED}
SELECT count(*) AS total_earthquakes, count(*) FILTER (WHERE region = 'Pakistan') AS pakistan_count,
       count(*) FILTER (WHERE mag > 6) AS critical_count, count(*) FILTER (WHERE mag > 5 AND mag <= 6) AS high_count,
       coalesce(round_even(avg(mag), 2), 0.0) AS average_magnitude, coalesce(round_even(max(mag), 2), 0.0) AS max_magnitude
FROM refreshed""",
    "states_hotspots": f"""{_BASE}, {_REFRESHED}
SELECT round(latitude, 1) + 0.0 AS lat_grid, round(longitude, 1) + 0.0 AS lon_grid, count(*) AS count, {_RISK} AS risk_level
FROM refreshed GROUP BY 1, 2""",
    "feed_folder_mixed_headers": f"""{_BASE}
SELECT event_id, time, latitude, longitude, CASE WHEN event_id % 3 <> 0 THEN depth END AS depth, mag, {_ODD_PLACE} AS place, type,
       CASE WHEN event_id % 3 = 0 THEN event_id % 10 END AS felt
FROM raw""",
    "csv_roundtrip": f"{_BASE} SELECT * REPLACE ({_ODD_PLACE} AS place) FROM quakes",
    "catalog_roundtrip": f"{_BASE} SELECT * FROM quakes",
    "union_messy_feeds": f"{_BASE}, {_MESSY} SELECT * FROM messy",
    "merge_messy_feeds": f"{_BASE}, {_MESSY} SELECT * FROM messy_merged",
    "merge_messy_report": f"""{_BASE}, {_MESSY}
SELECT count(*) AS total, count(*) FILTER (WHERE region = 'Pakistan') AS pakistan_count,
       count(*) FILTER (WHERE region = 'Global') AS global_count,
       count(*) FILTER (WHERE time IS NULL OR mag IS NULL) AS null_key_count
FROM messy_merged""",
    "build_catalog_from_csv": f"""{_BASE},
landed AS (
  SELECT event_id, time, latitude, longitude, depth, mag, {_ODD_PLACE} AS place, type, CAST(NULL AS BIGINT) AS felt, 0 AS feed
  FROM raw WHERE event_id % 3 <> 0
  UNION ALL
  SELECT event_id, time, latitude, longitude, NULL, mag, 'R ' || {_ODD_PLACE}, type, event_id % 10, 1
  FROM raw WHERE event_id % 3 = 0 OR event_id % 7 = 0),
read AS (
  SELECT * REPLACE (CASE WHEN event_id % 61 = 3 THEN NULL ELSE time END AS time,
                    CASE WHEN event_id % 53 = 11 THEN NULL ELSE mag END AS mag),
    CASE WHEN event_id % 61 = 3 THEN event_id % 5 END AS bad_time, CASE WHEN event_id % 53 = 11 THEN event_id % 4 END AS bad_mag
  FROM landed)
SELECT event_id, time, latitude, longitude, depth, mag, place, type, felt,
  CASE WHEN latitude BETWEEN 23 AND 37 AND longitude BETWEEN 60 AND 77 THEN 'Pakistan' ELSE 'Global' END AS region
FROM (SELECT *, row_number() OVER (PARTITION BY time, bad_time, mag, bad_mag
        ORDER BY feed, CAST(event_id AS VARCHAR)) AS rn FROM read) WHERE rn = 1""",
    "catalog_by_date_roundtrip": f"{_BASE} SELECT *, CAST(time AS DATE) AS event_date FROM quakes",
    "cell_profile_hotspots": _hotspots(),
    "cell_profile_hotspots_regional": _hotspots("WHERE region = 'Pakistan'"),
    "hotspot_job_global": _hotspots(),
    "replay_lines": f"""{_BASE}
SELECT time, latitude, longitude, depth, mag, {_LINE_PLACE} AS place, type, region, {_LINE_TIME} AS time_raw
FROM quakes WHERE mag IS NOT NULL""",
    "stream_watch_alerts": f"""{_BASE}, {_LINES}
SELECT time, place, mag, depth, {_STREAM_ALERT} AS alert_level, region = 'Pakistan' AS is_pakistan, time_raw
FROM lines WHERE mag > 5""",
    "stream_critical_alerts": f"""{_BASE}, {_LINES}
SELECT time, latitude, longitude, depth, mag, place, type, region,
       'CRITICAL !!' AS alert_level, region = 'Pakistan' AS is_pakistan, time_raw
FROM lines WHERE mag > 6""",
}
# The jobs' fused tables equal the direct ones.
ORACLE_SQL |= {fused: ORACLE_SQL[direct] for fused, direct in (
    ("batch_profile_count", "catalog_count"), ("batch_profile_mag_ranges", "mag_range_counts"),
    ("batch_profile_regions", "region_counts"), ("batch_profile_regional_stats", "regional_stats"),
    ("batch_job_top_places", "top_places"))}
