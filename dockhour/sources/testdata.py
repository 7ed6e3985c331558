"""Views over the driver's synthetic tables that play the reference's inputs.

The mapping is documented in FIXTURES.md §B; ``oracle/views.py`` holds the
same definitions as DuckDB SQL so both engines read identical inputs.

* rides: one row per ``events`` row.  city = event_type, station =
  user_id % 25 written as ``n`` / ``n.0`` / `` n``, started_at = ts, ride
  order = event_id, weather / POI / user type / calendar derived from
  ``value`` and ``props.k``.
* supplemental rides: the same rides shifted by +1 hour (a second source).
* station features, weather table: lookups derived from the rides.
* points / segments / polygons: spatial layers from ``customer`` and ``part``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.time import calendar_fields

# Cities of the testdata that play city 1 / city 2 / city 3 (holdout).
TESTDATA_HOLDOUT_CITY = "error"
TESTDATA_EVAL_CAPS = {"click": 300, "view": 300, "error": 200}
N_STATIONS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _d(x: float) -> Column:
    return F.lit(float(x))


def rides_from_events(events: DataFrame, shift_hours: int = 0) -> DataFrame:
    e = events
    if shift_hours:
        e = e.withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(shift_hours)))
    e = e.select("event_id", "ts", "user_id", "event_type", "value",
                 _k().alias("k"), (F.col("user_id") % N_STATIONS).alias("n"))
    k = F.col("k").cast("double")
    n = F.col("n")
    miss_w = (F.col("event_id") % 11) == 0
    view = F.col("event_type") == "view"

    def w(expr):
        return F.when(~miss_w, expr)

    def poi(expr):
        return F.when(view, _d(0.0)).otherwise(expr)

    cal = calendar_fields("ts")
    return e.select(
        F.col("event_id").alias("ride_id"),
        F.col("ts").alias("started_at"),
        (F.when(F.col("event_id") % 3 == 0, n.cast("string"))
         .when(F.col("event_id") % 3 == 1, F.concat(n.cast("string"), F.lit(".0")))
         .otherwise(F.concat(F.lit(" "), n.cast("string")))).alias("start_station_id"),
        ((F.col("user_id") + F.col("event_id")) % N_STATIONS).cast("string").alias("end_station_id"),
        F.col("value").alias("usage_time_minutes"),
        F.lit(None).cast("double").alias("distance_meters"),
        (F.when(view, F.lit(None).cast("string"))
         .when(F.col("user_id") % 2 == 0, F.lit("member")).otherwise(F.lit("casual"))).alias("user_type"),
        (_d(38.8) + (n % 5).cast("double") * _d(0.01)).alias("start_lat"),
        (_d(-77.1) + F.floor(n / 5).cast("double") * _d(0.01)).alias("start_lng"),
        w(F.col("value")).alias("temperature_2m"),
        w(k).alias("relative_humidity_2m"),
        w(F.col("value") - _d(2.0)).alias("apparent_temperature"),
        w(k / _d(100.0)).alias("precipitation"),
        w(k / _d(200.0)).alias("rain"),
        w(_d(0.0)).alias("snowfall"),
        w(k).alias("cloud_cover"),
        w(F.col("value") / _d(10.0)).alias("wind_speed_10m"),
        F.col("event_type").alias("city"),
        poi(k * _d(10.0)).alias("bike_lane_length_500m"),
        poi(k * _d(100.0)).alias("park_area_500m"),
        poi((F.col("k") % 3).cast("double")).alias("university_count_1000m"),
        poi((F.col("k") % 7).cast("double")).alias("office_poi_count_1000m"),
        poi((F.col("k") % 11).cast("double")).alias("retail_poi_count_1000m"),
        poi((F.col("k") % 5).cast("double")).alias("restaurant_cafe_count_500m"),
        poi((F.col("k") % 4).cast("double")).alias("transit_stop_count_500m"),
        F.when(view | (F.col("k") % 10 == 0), _d(-1.0)).otherwise(k * _d(20.0))
        .alias("distance_to_nearest_rail_station"),
        (n.cast("double") * _d(100.0) + _d(50.0)).alias("distance_to_city_center"),
        *[cal[c].alias(c) for c in ["date", "weekday", "weekend", "holiday", "holiday_name",
                                     "working_day", "hour_ts"]],
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_from_events(table(spark, sf_dir, "events"))


def supplemental_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_from_events(table(spark, sf_dir, "events"), shift_hours=1)


def start_side_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw start-side extract (rental_id, started_at as text, station id, name, lat, lng)."""
    r = rides(spark, sf_dir)
    return r.select(
        F.col("ride_id").alias("rental_id"),
        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started_at"),
        F.col("start_station_id"),
        F.concat(F.lit("Station "), F.trim(F.col("start_station_id"))).alias("start_station_name"),
        F.col("start_lat"), F.col("start_lng"), F.col("city"),
    )


def start_side_scattered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start-side extract whose rides scatter around their station; some name no station."""
    r = start_side_rides(spark, sf_dir)
    step = (F.col("rental_id") % 7).cast("double") * _d(0.0001)
    return r.withColumns({
        "start_station_id": F.when(F.col("rental_id") % 53 != 0, F.col("start_station_id")),
        "start_lat": F.col("start_lat") + step, "start_lng": F.col("start_lng") - step})


def station_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station lookup keyed by numeric id: lat/lng + 8 POI + distance to centre."""
    n = (F.col("user_id") % N_STATIONS)
    st = table(spark, sf_dir, "events").select(n.alias("n")).distinct()
    nd = F.col("n").cast("double")
    return st.select(
        F.col("n").cast("string").alias("start_station_id"),
        (_d(38.8) + (F.col("n") % 5).cast("double") * _d(0.01)).alias("lat"),
        (_d(-77.1) + F.floor(F.col("n") / 5).cast("double") * _d(0.01)).alias("lng"),
        (nd * _d(10.0)).alias("bike_lane_length_500m"),
        (nd * _d(100.0)).alias("park_area_500m"),
        (F.col("n") % 3).cast("double").alias("university_count_1000m"),
        (F.col("n") % 7).cast("double").alias("office_poi_count_1000m"),
        (F.col("n") % 11).cast("double").alias("retail_poi_count_1000m"),
        (F.col("n") % 5).cast("double").alias("restaurant_cafe_count_500m"),
        (F.col("n") % 4).cast("double").alias("transit_stop_count_500m"),
        F.when(F.col("n") % 10 == 0, _d(-1.0)).otherwise(nd * _d(20.0))
        .alias("distance_to_nearest_rail_station"),
        (nd * _d(100.0) + _d(50.0)).alias("distance_to_city_center"),
    )


def weather_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather lookup (one row per hour seen in events), hour_ts as text."""
    e = table(spark, sf_dir, "events")
    from ..functions.keys import floor_hour
    h = e.select(floor_hour("ts").alias("h")).distinct()
    epoch_h = (F.unix_seconds(F.col("h").cast("timestamp")) / 3600).cast("bigint")
    return h.select(
        F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("hour_ts"),
        ((epoch_h % 30).cast("double") - _d(5.0)).alias("temperature_2m"),
        ((epoch_h % 60).cast("double") + _d(30.0)).alias("relative_humidity_2m"),
        ((epoch_h % 30).cast("double") - _d(7.0)).alias("apparent_temperature"),
        ((epoch_h % 9).cast("double") / _d(10.0)).alias("precipitation"),
        ((epoch_h % 9).cast("double") / _d(20.0)).alias("rain"),
        _d(0.0).alias("snowfall"),
        ((epoch_h % 101).cast("double")).alias("cloud_cover"),
        ((epoch_h % 17).cast("double") / _d(2.0)).alias("wind_speed_10m"),
    )


# --- spatial layers --------------------------------------------------------

def poi_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OSM-like point elements from ``customer``: id, tags map, lat/lon or center."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    lat = _d(38.78) + (key % 97).cast("double") * _d(0.0007)
    lon = _d(-77.12) + ((key * 7) % 89).cast("double") * _d(0.0009)
    seg = F.col("c_mktsegment")
    tags = (F.when(seg == "AUTOMOBILE", F.create_map(F.lit("highway"), F.lit("bus_stop")))
            .when(seg == "BUILDING", F.create_map(F.lit("office"), F.lit("company")))
            .when(seg == "FURNITURE", F.create_map(F.lit("shop"), F.lit("furniture")))
            .when(seg == "HOUSEHOLD", F.create_map(
                F.lit("amenity"), F.when(key % 2 == 0, F.lit("restaurant")).otherwise(F.lit("cafe"))))
            .when(key % 5 == 0, F.create_map(F.lit("railway"), F.lit("station")))
            .otherwise(F.create_map(F.lit("amenity"), F.lit("university"))))
    as_way = (key % 4) == 3   # ways carry a centre instead of their own coordinates
    return c.select(
        key.alias("element_id"),
        F.when(as_way, F.lit("way")).otherwise(F.lit("node")).alias("element_type"),
        tags.alias("tags"),
        F.when(~as_way, lat).alias("lat"),
        F.when(~as_way, lon).alias("lon"),
        F.when(as_way, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("center"),
    )


def line_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycleway ways with geometry (2 points) from ``part`` rows of two types."""
    p = table(spark, sf_dir, "part").filter(F.col("p_type").isin("ECONOMY", "STANDARD", "SMALL"))
    key = F.col("p_partkey")
    lat0 = _d(38.79) + (key % 53).cast("double") * _d(0.001)
    lon0 = _d(-77.11) + (key % 59).cast("double") * _d(0.001)
    lat1 = lat0 + F.col("p_size").cast("double") * _d(0.0001)
    lon1 = lon0 + ((F.col("p_size") % 7) - 3).cast("double") * _d(0.0002)
    return p.select(
        key.alias("element_id"),
        F.create_map(F.lit("highway"), F.lit("cycleway")).alias("tags"),
        F.array(F.struct(lat0.alias("lat"), lon0.alias("lon")),
                F.struct(lat1.alias("lat"), lon1.alias("lon"))).alias("geometry"),
    )


def polygon_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Park ways (closed triangles) from the other ``part`` types."""
    p = table(spark, sf_dir, "part").filter(F.col("p_type").isin("MEDIUM", "PROMO", "LARGE"))
    key = F.col("p_partkey")
    lat0 = _d(38.79) + (key % 47).cast("double") * _d(0.001)
    lon0 = _d(-77.11) + (key % 61).cast("double") * _d(0.001)
    s = F.col("p_size").cast("double") * _d(0.0002)
    return p.select(
        key.alias("element_id"),
        F.create_map(F.lit("leisure"), F.lit("park")).alias("tags"),
        F.array(F.struct(lat0.alias("lat"), lon0.alias("lon")),
                F.struct((lat0 + s).alias("lat"), lon0.alias("lon")),
                F.struct(lat0.alias("lat"), (lon0 + s).alias("lon")),
                F.struct(lat0.alias("lat"), lon0.alias("lon"))).alias("geometry"),
    )


def predictions(labels: DataFrame) -> DataFrame:
    """Two prediction tables keyed by id (model m1 has negative values)."""
    i = F.col("id")
    m1 = labels.select(F.lit("m1").alias("model"), i, ((i % 7).cast("double") - _d(1.5)).alias("prediction"))
    m2 = labels.select(F.lit("m2").alias("model"), i, ((i % 5).cast("double") * _d(0.5)).alias("prediction"))
    return m1.unionByName(m2)


def predictions_with_failure(labels: DataFrame) -> DataFrame:
    """m1, m2 plus a model m3 whose every 100th prediction is NaN (fails validation)."""
    i = F.col("id")
    m3 = labels.select(F.lit("m3").alias("model"), i,
                       F.when(i % 100 == 0, F.lit(float("nan"))).otherwise(_d(1.0)).alias("prediction"))
    return predictions(labels).unionByName(m3)


# Column order of ``rides`` (used by the oracle to unpivot the same columns).
RIDES_VIEW_COLS = [
    "ride_id", "started_at", "start_station_id", "end_station_id", "usage_time_minutes",
    "distance_meters", "user_type", "start_lat", "start_lng", "temperature_2m",
    "relative_humidity_2m", "apparent_temperature", "precipitation", "rain", "snowfall",
    "cloud_cover", "wind_speed_10m", "city", "bike_lane_length_500m", "park_area_500m",
    "university_count_1000m", "office_poi_count_1000m", "retail_poi_count_1000m",
    "restaurant_cafe_count_500m", "transit_stop_count_500m", "distance_to_nearest_rail_station",
    "distance_to_city_center", "date", "weekday", "weekend", "holiday", "holiday_name",
    "working_day", "hour_ts",
]


def city_station_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-city station lookups (one per distinct city and station seen in events)."""
    cs = (table(spark, sf_dir, "events")
          .select(F.col("event_type").alias("city"), (F.col("user_id") % N_STATIONS).alias("n")).distinct())
    feats = station_features(spark, sf_dir).withColumn("n", F.col("start_station_id").cast("bigint"))
    return cs.join(feats, "n").drop("n")


def city_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-city hourly weather (one row per city and hour seen in events), hour_ts as text."""
    from ..functions.keys import floor_hour
    ch = (table(spark, sf_dir, "events")
          .select(F.col("event_type").alias("city"), floor_hour("ts").alias("h")).distinct())
    w = weather_table(spark, sf_dir)
    ch = ch.withColumn("hour_ts", F.date_format("h", "yyyy-MM-dd HH:mm:ss")).drop("h")
    off = F.length("city").cast("double")
    return ch.join(w, "hour_ts").withColumn("temperature_2m", F.col("temperature_2m") + off)
