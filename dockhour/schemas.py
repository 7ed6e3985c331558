"""Column groups and input schemas.

FIXED VALUES: the column names, their order and the sentinel strings below
must equal the reference's for the tables to be interchangeable.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (names, order and sentinels shared with the reference data)
# ---------------------------------------------------------------------------
WEATHER_COLS = [
    "temperature_2m", "relative_humidity_2m", "apparent_temperature", "precipitation",
    "rain", "snowfall", "cloud_cover", "wind_speed_10m",
]
CALENDAR_COLS = ["date", "weekday", "weekend", "holiday", "holiday_name", "working_day"]
TABLE_CALENDAR_COLS = ["weekend", "holiday", "working_day", "holiday_name"]
CALENDAR_FLAGS = ["weekend", "holiday", "working_day"]
STATION_META_COLS = [
    "start_lat", "start_lng", "bike_lane_length_500m", "park_area_500m",
    "university_count_1000m", "office_poi_count_1000m", "retail_poi_count_1000m",
    "restaurant_cafe_count_500m", "transit_stop_count_500m",
    "distance_to_nearest_rail_station", "distance_to_city_center",
]
POI_COLS = [
    "bike_lane_length_500m", "park_area_500m", "university_count_1000m",
    "office_poi_count_1000m", "retail_poi_count_1000m", "restaurant_cafe_count_500m",
    "transit_stop_count_500m", "distance_to_nearest_rail_station", "distance_to_city_center",
]
POI8_COLS = POI_COLS[:8]
POI_PRESENCE_COLS = POI_COLS[:7]
POI_COUNT_COLS = [
    "university_count_1000m", "office_poi_count_1000m", "retail_poi_count_1000m",
    "restaurant_cafe_count_500m", "transit_stop_count_500m",
]
RIDE_ONLY_COLS = ["started_at", "ended_at", "end_station_id", "usage_time_minutes",
                  "distance_meters", "user_type"]
FORBIDDEN_TARGET_COLS = [
    "demand", "started_at", "ended_at", "end_station_id", "usage_time_minutes",
    "distance_meters", "user_type", "prediction", "predicted_demand",
]
TE_COLS = ["te_city", "te_city_how", "te_station", "te_station_how"]
RIDE_COLS = [
    "started_at", "ended_at", "start_station_id", "end_station_id", "usage_time_minutes",
    "distance_meters", "user_type", "start_lat", "start_lng",
    "temperature_2m", "relative_humidity_2m", "apparent_temperature", "precipitation",
    "rain", "snowfall", "cloud_cover", "wind_speed_10m", "city",
    "bike_lane_length_500m", "park_area_500m", "university_count_1000m",
    "office_poi_count_1000m", "retail_poi_count_1000m", "restaurant_cafe_count_500m",
    "transit_stop_count_500m", "distance_to_nearest_rail_station", "distance_to_city_center",
    "date", "weekday", "weekend", "holiday", "holiday_name", "working_day", "hour_ts",
]
ENRICHED_OUT_COLS = (
    ["started_at", "hour_ts", "city", "start_station_id", "start_station_name",
     "start_lat", "start_lng"] + WEATHER_COLS + POI_COLS
    + ["date", "weekday", "weekend", "holiday", "holiday_name", "working_day"]
)
MISSING_STATION = "__missing_station__"
MISSING_CITY = "__missing_city__"
ALL_CITIES_BUILDER = "__all_cities__"
ALL_CITIES_TABLE = "__all__"
DEFAULT_KEEP_HOURS = tuple(range(6, 23))        # 06..22 inclusive
DEFAULT_MAX_EVAL_HOURS = {"city 1": 300, "city 2": 300, "city 3": 200}
DEFAULT_MIN_WINDOW_HOURS = 72
HOLDOUT_CITY = "city 3"
VAL_FRACTION = 0.20
EARTH_RADIUS_M = 6371000.0
# ---------------------------------------------------------------------------

_DOUBLE_COLS = set(WEATHER_COLS) | set(POI_COLS) | {
    "usage_time_minutes", "distance_meters", "start_lat", "start_lng"}
_INT_COLS = {"weekday", "weekend", "holiday", "working_day"}


def rides_csv_schema() -> T.StructType:
    """Declared schema for ride CSVs: ids stay strings, times are parsed later."""
    fields = []
    for c in RIDE_COLS:
        if c in _DOUBLE_COLS:
            t = T.DoubleType()
        elif c in _INT_COLS:
            t = T.IntegerType()
        else:
            t = T.StringType()
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


def present(df_columns, wanted):
    """Columns of ``wanted`` that exist, in ``wanted`` order (plan-time only)."""
    have = set(df_columns)
    return [c for c in wanted if c in have]
