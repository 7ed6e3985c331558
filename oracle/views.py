"""The testdata views of ``dockhour.sources.testdata`` written as DuckDB SQL CTEs."""
from __future__ import annotations

from dockhour.functions.holidays import holiday_name_sql


def _rides_select(shift: str = "") -> str:
    ts = f"(ts + INTERVAL {shift} HOUR)" if shift else "ts"
    hol = holiday_name_sql("CAST(e.ts AS DATE)")
    return f"""
  SELECT e.event_id AS ride_id, e.ts AS started_at,
    CASE WHEN e.event_id % 3 = 0 THEN CAST(e.n AS VARCHAR)
         WHEN e.event_id % 3 = 1 THEN CAST(e.n AS VARCHAR) || '.0'
         ELSE ' ' || CAST(e.n AS VARCHAR) END AS start_station_id,
    CAST((e.user_id + e.event_id) % 25 AS VARCHAR) AS end_station_id,
    e.value AS usage_time_minutes,
    CAST(NULL AS DOUBLE) AS distance_meters,
    CASE WHEN e.event_type = 'view' THEN NULL WHEN e.user_id % 2 = 0 THEN 'member' ELSE 'casual' END AS user_type,
    CAST(38.8 AS DOUBLE) + CAST(e.n % 5 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS start_lat,
    CAST(-77.1 AS DOUBLE) + CAST(e.n // 5 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS start_lng,
    CASE WHEN e.event_id % 11 <> 0 THEN e.value END AS temperature_2m,
    CASE WHEN e.event_id % 11 <> 0 THEN CAST(e.k AS DOUBLE) END AS relative_humidity_2m,
    CASE WHEN e.event_id % 11 <> 0 THEN e.value - CAST(2.0 AS DOUBLE) END AS apparent_temperature,
    CASE WHEN e.event_id % 11 <> 0 THEN CAST(e.k AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS precipitation,
    CASE WHEN e.event_id % 11 <> 0 THEN CAST(e.k AS DOUBLE) / CAST(200.0 AS DOUBLE) END AS rain,
    CASE WHEN e.event_id % 11 <> 0 THEN CAST(0.0 AS DOUBLE) END AS snowfall,
    CASE WHEN e.event_id % 11 <> 0 THEN CAST(e.k AS DOUBLE) END AS cloud_cover,
    CASE WHEN e.event_id % 11 <> 0 THEN e.value / CAST(10.0 AS DOUBLE) END AS wind_speed_10m,
    e.event_type AS city,
    CASE WHEN e.event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(e.k AS DOUBLE) * CAST(10.0 AS DOUBLE) END AS bike_lane_length_500m,
    CASE WHEN e.event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(e.k AS DOUBLE) * CAST(100.0 AS DOUBLE) END AS park_area_500m,
    CASE WHEN e.event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(e.k % 3 AS DOUBLE) END AS university_count_1000m,
    CASE WHEN e.event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(e.k % 7 AS DOUBLE) END AS office_poi_count_1000m,
    CASE WHEN e.event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(e.k % 11 AS DOUBLE) END AS retail_poi_count_1000m,
    CASE WHEN e.event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(e.k % 5 AS DOUBLE) END AS restaurant_cafe_count_500m,
    CASE WHEN e.event_type = 'view' THEN CAST(0.0 AS DOUBLE) ELSE CAST(e.k % 4 AS DOUBLE) END AS transit_stop_count_500m,
    CASE WHEN e.event_type = 'view' OR e.k % 10 = 0 THEN CAST(-1.0 AS DOUBLE) ELSE CAST(e.k AS DOUBLE) * CAST(20.0 AS DOUBLE) END AS distance_to_nearest_rail_station,
    CAST(e.n AS DOUBLE) * CAST(100.0 AS DOUBLE) + CAST(50.0 AS DOUBLE) AS distance_to_city_center,
    strftime(e.ts, '%Y-%m-%d') AS date,
    CAST(isodow(e.ts) - 1 AS INTEGER) AS weekday,
    CAST(isodow(e.ts) - 1 >= 5 AS INTEGER) AS weekend,
    CAST(({hol}) IS NOT NULL AS INTEGER) AS holiday,
    {hol} AS holiday_name,
    CAST(NOT (isodow(e.ts) - 1 >= 5) AND ({hol}) IS NULL AS INTEGER) AS working_day,
    date_trunc('hour', e.ts) AS hour_ts
  FROM (SELECT event_id, {ts} AS ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id % 25 AS n
        FROM events) e"""


RIDES = f"rides AS ({_rides_select()})"
SUPPLEMENTAL = f"supp_rides AS ({_rides_select('1')})"

STATION_FEATURES = """station_features AS (
  SELECT CAST(n AS VARCHAR) AS start_station_id,
    CAST(38.8 AS DOUBLE) + CAST(n % 5 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS lat,
    CAST(-77.1 AS DOUBLE) + CAST(n // 5 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS lng,
    CAST(n AS DOUBLE) * CAST(10.0 AS DOUBLE) AS bike_lane_length_500m,
    CAST(n AS DOUBLE) * CAST(100.0 AS DOUBLE) AS park_area_500m,
    CAST(n % 3 AS DOUBLE) AS university_count_1000m,
    CAST(n % 7 AS DOUBLE) AS office_poi_count_1000m,
    CAST(n % 11 AS DOUBLE) AS retail_poi_count_1000m,
    CAST(n % 5 AS DOUBLE) AS restaurant_cafe_count_500m,
    CAST(n % 4 AS DOUBLE) AS transit_stop_count_500m,
    CASE WHEN n % 10 = 0 THEN CAST(-1.0 AS DOUBLE) ELSE CAST(n AS DOUBLE) * CAST(20.0 AS DOUBLE) END AS distance_to_nearest_rail_station,
    CAST(n AS DOUBLE) * CAST(100.0 AS DOUBLE) + CAST(50.0 AS DOUBLE) AS distance_to_city_center
  FROM (SELECT DISTINCT user_id % 25 AS n FROM events))"""

WEATHER = """weather AS (
  SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour_ts,
    CAST(eh % 30 AS DOUBLE) - CAST(5.0 AS DOUBLE) AS temperature_2m,
    CAST(eh % 60 AS DOUBLE) + CAST(30.0 AS DOUBLE) AS relative_humidity_2m,
    CAST(eh % 30 AS DOUBLE) - CAST(7.0 AS DOUBLE) AS apparent_temperature,
    CAST(eh % 9 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS precipitation,
    CAST(eh % 9 AS DOUBLE) / CAST(20.0 AS DOUBLE) AS rain,
    CAST(0.0 AS DOUBLE) AS snowfall,
    CAST(eh % 101 AS DOUBLE) AS cloud_cover,
    CAST(eh % 17 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS wind_speed_10m
  FROM (SELECT h, CAST(epoch(h) AS BIGINT) // 3600 AS eh
        FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events)))"""


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)
