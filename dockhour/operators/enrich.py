"""Enrichment: calendar, weather, station features and computed POI columns
(H1-H8, H11, D4-D6, D8).

Lookups are joined, never looped: station features by numeric station id,
weather by hour, POI columns computed once per *distinct station* (spatial
joins in ``operators.spatial``) and joined back to the rides.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import haversine_m
from ..functions.keys import conform_schema, floor_hour
from ..functions.time import calendar_fields, format_ts
from ..schemas import POI8_COLS, POI_COUNT_COLS, RIDE_COLS, WEATHER_COLS
from . import spatial as S
from .joins import join_station_features, numeric_station_id

# FIXED VALUES: POI columns, their source category and radius in metres.
COUNT_SPECS = [
    ("university_count_1000m", "university", 1000.0),
    ("office_poi_count_1000m", "office", 1000.0),
    ("retail_poi_count_1000m", "retail", 1000.0),
    ("restaurant_cafe_count_500m", "food", 500.0),
    ("transit_stop_count_500m", "transit", 500.0),
]
LINE_SPEC = ("bike_lane_length_500m", "cycle", 500.0)
AREA_SPEC = ("park_area_500m", "park", 500.0)
NEAREST_SPEC = ("distance_to_nearest_rail_station", "rail")


def add_calendar(df: DataFrame, ts_col: str = "started_at", hour_text: bool = True) -> DataFrame:
    """Date, weekday, weekend, holiday, holiday_name, working_day, hour_ts."""
    cal = calendar_fields(ts_col)
    if hour_text:
        cal["hour_ts"] = format_ts(cal["hour_ts"])
    return df.withColumns(cal)


def _ts(df: DataFrame, c: str) -> DataFrame:
    from ..functions.keys import _as_ntz
    return df.withColumn(c, _as_ntz(df, c))


def enrich_rides(rides: DataFrame, features: DataFrame, weather: DataFrame, city: str,
                 ts_col: str | None = None) -> DataFrame:
    """H1: station features (by numeric id) + calendar + hourly weather; set the city."""
    ts_col = ts_col or ("started_at" if "started_at" in rides.columns else "hour_ts")
    r = _ts(rides, ts_col)
    r = join_station_features(r, features)
    r = add_calendar(r, ts_col)
    w = _ts(weather, "hour_ts")
    w = w.withColumn("hour_ts", format_ts(floor_hour("hour_ts")))
    return r.join(w, "hour_ts", "left").withColumn("city", F.lit(city))


def enrich_fullyear(rides: DataFrame, city_features: DataFrame, city_weather: DataFrame,
                    out_cols) -> DataFrame:
    """H2: every city in one job: features keyed by (city, station id), weather by
    (city, hour); fixed output columns, absent ones NULL; hour_ts as text."""
    r = _ts(rides, "started_at").withColumn("start_station_id", numeric_station_id("start_station_id"))
    cal = calendar_fields("started_at")
    r = r.withColumns(cal)
    feats = city_features.withColumnsRenamed({"lat": "start_lat", "lng": "start_lng"}).withColumn(
        "start_station_id", numeric_station_id("start_station_id"))
    r = r.drop(*[c for c in feats.columns if c not in ("city", "start_station_id") and c in r.columns])
    r = r.join(feats, ["city", "start_station_id"], "left")
    w = _ts(city_weather, "hour_ts").withColumn("hour_ts", floor_hour("hour_ts"))
    r = r.drop(*[c for c in WEATHER_COLS if c in r.columns]).join(w, ["city", "hour_ts"], "left")
    r = r.withColumn("hour_ts", format_ts("hour_ts"))
    return conform_schema(r, out_cols, _TYPES)


_TYPES = {"started_at": "timestamp_ntz", "hour_ts": "string", "city": "string", "start_station_id": "bigint",
          "start_station_name": "string", "date": "string", "holiday_name": "string",
          "weekday": "int", "weekend": "int", "holiday": "int", "working_day": "int",
          "ended_at": "string", "end_station_id": "string", "user_type": "string"}


@dataclass
class PoiLayers:
    """Element tables (OSM-like): points with tags/lat/lon/center, line ways and
    polygon ways with tags/geometry."""
    points: DataFrame
    lines: DataFrame
    polygons: DataFrame
    rules: dict = None


def station_poi_features(stations: DataFrame, layers: PoiLayers, lat0: Column | None = None,
                         lng0: Column | None = None) -> DataFrame:
    """H5: the eight POI columns per station (``station_id, lat, lng``); stations without
    coordinates get NULLs.  Projection centre defaults to the mean station position."""
    rules = layers.rules or S.POI_RULES
    from ..session import cut_lineage
    stations = cut_lineage(stations.select("station_id", "lat", "lng"))   # one row per station,
    if lat0 is None:                                                      # read by ~10 joins below
        lat0, lng0 = S.projection_centre(stations)
    st = S.project(stations, "lat", "lng", lat0, lng0)
    pts = S.poi_category_match(S.elements_to_points(layers.points), rules)
    pts = S.project(pts, "lat", "lon", lat0, lng0)
    out = st.select("station_id")
    for col, cat, r in COUNT_SPECS:
        c = S.radius_count(st, pts.filter(F.col("category") == cat), r, col)
        out = out.join(c, "station_id", "left")
    rail = S.nearest_distance(st, pts.filter(F.col("category") == NEAREST_SPEC[1]), NEAREST_SPEC[0])
    lines = S.poi_category_match(layers.lines, rules).filter(F.col("category") == LINE_SPEC[1])
    ledges = S.edges_xy(S.elements_to_edges(lines.drop("tags", "category"), 2), lat0, lng0)
    length = S.line_length_in_radius(st, ledges, LINE_SPEC[2], LINE_SPEC[0])
    polys = S.poi_category_match(layers.polygons, rules).filter(F.col("category") == AREA_SPEC[1])
    pedges = S.edges_xy(S.elements_to_edges(polys.drop("tags", "category"), 3), lat0, lng0)
    area = S.polygon_area_in_radius(st, pedges, AREA_SPEC[2], AREA_SPEC[0])
    out = out.join(length, "station_id", "left").join(area, "station_id", "left").join(rail, "station_id", "left")
    nocoord = st.select("station_id", F.col("x").isNull().alias("_nc"))
    out = out.join(nocoord, "station_id", "left")
    return out.select("station_id", *[F.when(~F.col("_nc"), F.col(c)).alias(c) for c in POI8_COLS])


def distance_to_center(stations: DataFrame, lat0, lng0, out: str = "distance_to_city_center") -> DataFrame:
    """H6: haversine metres to the centre, rounded half-even to 0.1."""
    return stations.withColumn(out, F.bround(haversine_m("lat", "lng", lat0, lng0), 1))


def positive_median_ratio(paired: DataFrame, cols=POI8_COLS, source_suffix: str = "_src",
                          own_suffix: str = "_own",
                          fixed=("distance_to_nearest_rail_station",)) -> DataFrame:
    """Calibration factors median(source > 0) / median(own > 0) per column over
    stations present in both sources (``paired`` has ``<col><suffix>`` columns);
    1.0 when undefined; the ``fixed`` columns stay 1.0.  One aggregate, one row."""
    exprs = []
    for c in cols:
        if c in fixed:
            exprs.append(F.lit(1.0).alias(c))
            continue
        s, o = F.col(c + source_suffix).cast("double"), F.col(c + own_suffix).cast("double")
        mt, mk = F.median(F.when(s > 0, s)), F.median(F.when(o > 0, o))
        exprs.append(F.when(mk > 0, mt / mk).otherwise(F.lit(1.0)).alias(c))
    return paired.agg(*exprs)


def poi_calibrate(computed: DataFrame, factors: dict, cols=POI8_COLS,
                  int_cols=POI_COUNT_COLS) -> DataFrame:
    """H7: scale each column by its factor, round half-even to 0.1 where the factor is
    not 1, counts back to integers.  ``factors`` is the one row of
    ``positive_median_ratio`` (eight numbers, read once as parameters)."""
    out = {}
    for c in cols:
        f = factors[c]
        v = F.col(c) if f is None or f == 1.0 else F.bround(F.col(c) * F.lit(float(f)), 1)
        if f is None:
            v = F.lit(None).cast("double")
        if c in int_cols:
            v = F.bround(v, 0).cast("bigint")
        out[c] = v
    return computed.withColumns(out)


def replace_columns(base: DataFrame, computed: DataFrame, cols, key: str, order) -> DataFrame:
    """H8: drop the blank columns, left-join the computed ones, restore the column order."""
    b = base.drop(*[c for c in cols if c in base.columns])
    j = b.join(computed.select(key, *cols), key, "left")
    return j.select(*[c for c in order if c in j.columns])


def poi_sanity(own: DataFrame, source: DataFrame, cols=POI8_COLS, city_col: str = "city") -> DataFrame:
    """Median of positive values per column, own computation vs each source city."""
    def long(df, who):
        keys = [city_col] if city_col in df.columns else []
        lf = df.unpivot(keys, list(cols), "column", "value") if keys else df.unpivot([], list(cols), "column", "value")
        if not keys:
            lf = lf.withColumn(city_col, F.lit(who))
        return lf.groupBy(city_col, "column").agg(
            F.median(F.when(F.col("value") > 0, F.col("value").cast("double"))).alias("median_positive"))
    return long(own, "own").unionByName(long(source, "source"))


NO_STATION = "(no station)"


def enrich_city(rides: DataFrame, weather: DataFrame | None = None, layers: PoiLayers | None = None,
                centroid: tuple[float, float] | None = None, city: str = "city ?") -> DataFrame:
    """H3: a new city's start-side rides -> the full 34-column ride schema.

    Calendar always; weather joined on the hour text when given; POI computed once
    per distinct station (median coordinates) when layers are given, else NULL.  Rides
    keep their own coordinates; rides without a station count as one station."""
    df = rides if "city" in rides.columns else rides.withColumn("city", F.lit(city))
    for c in ("start_lat", "start_lng"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast("double"))
    df = add_calendar(_ts(df, "started_at"), "started_at")
    if weather is not None:
        df = df.join(weather.select("hour_ts", *WEATHER_COLS), "hour_ts", "left")
    if layers is not None:
        if centroid is None:
            from .aggregates import city_centroid
            row = city_centroid(df).first()
            lat0, lng0 = F.lit(row["lat0"]), F.lit(row["lng0"])
        else:
            lat0, lng0 = F.lit(float(centroid[0])), F.lit(float(centroid[1]))
        from ..session import cut_lineage
        from .aggregates import station_median_coords
        # Rides without a station share one: POI follow the station, coordinates stay the ride's.
        df = df.withColumn("_station", F.coalesce(F.col("start_station_id").cast("string"),
                                                  F.lit(NO_STATION)))
        st = cut_lineage(station_median_coords(df, "_station").withColumnsRenamed(
            {"_station": "station_id", "start_lat": "lat", "start_lng": "lng"}))
        poi = station_poi_features(st, layers)
        poi = poi.join(distance_to_center(st.select("station_id", "lat", "lng"), lat0, lng0), "station_id")
        df = df.join(poi.select(F.col("station_id").alias("_station"), *POI8_COLS,
                                "distance_to_city_center"), "_station", "left").drop("_station")
    return conform_schema(df, RIDE_COLS, {**_TYPES, "start_station_id": "string", "started_at": "timestamp_ntz"})


def us_holiday_dim(df: DataFrame, ts_col: str = "started_at") -> DataFrame:
    """H4: one row per day between the first and last date of ``df`` with the US holiday
    name (NULL if none).  The day list comes from a one-row min/max aggregate."""
    b = df.agg(F.to_date(F.min(ts_col)).alias("lo"), F.to_date(F.max(ts_col)).alias("hi"))
    days = b.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    from ..functions.holidays import us_holiday_name
    return days.withColumn("holiday_name", us_holiday_name("day")).withColumn(
        "holiday", F.col("holiday_name").isNotNull().cast("int"))
