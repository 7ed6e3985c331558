"""Ride aggregates: demand counts and first-non-null metadata.

First-non-null is order dependent; Spark has no row order, so the order is an
explicit column list (``order_cols``, e.g. ``["started_at", "ride_id"]``).  The
aggregate is ``min(struct(order..., value))`` over non-null values, which is
exact under partial aggregation and can be rolled up: the first value per
station is the minimum of the per-station-hour firsts.  That lets one shuffle
of the rides feed the demand counts, the station metadata and the city-hour
metadata (the three consumers share one Exchange in the physical plan).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_V = "__v_"
_O = "__o_"


def _order(order_cols) -> Column:
    """One ordering expression: the column itself, or a struct for several columns.

    A single numeric order column keeps the aggregation buffers fixed-width, so
    Spark can use hash aggregation; the order must be unique per row.
    """
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    if len(cols) == 1:
        return F.col(cols[0])
    return F.struct(*[F.col(c) for c in cols])


def first_non_null(value_col: str, order_cols) -> Column:
    """Aggregate: value of the earliest row (by ``order_cols``) whose value is not NULL."""
    v = F.col(value_col)
    return F.min_by(v, F.when(v.isNotNull(), _order(order_cols)))


def hour_rollup(keyed: DataFrame, hour_col: str, station_cols, city_hour_cols,
                order_cols) -> DataFrame:
    """One row per (city_key, station_key, hour): demand, and per metadata column the
    first non-null value in that hour plus its order key.

    The only aggregate that reads rides; everything else rolls up from it.
    """
    aggs = [F.count(F.lit(1)).alias("demand")]
    o = _order(order_cols)
    for c in list(dict.fromkeys(list(station_cols) + list(city_hour_cols))):
        v = F.col(c)
        ordv = F.when(v.isNotNull(), o)
        aggs += [F.min_by(v, ordv).alias(_V + c), F.min(ordv).alias(_O + c)]
    return keyed.groupBy("city_key", "station_key", hour_col).agg(*aggs)


def demand_counts(keyed_or_rollup: DataFrame, hour_col: str) -> DataFrame:
    """Rides per (city_key, station_key, hour)."""
    if "demand" in keyed_or_rollup.columns:
        return keyed_or_rollup.select("city_key", "station_key", hour_col, "demand")
    return (keyed_or_rollup.groupBy("city_key", "station_key", hour_col)
            .agg(F.count(F.lit(1)).alias("demand")))


def _meta(rollup: DataFrame, keys, cols) -> DataFrame:
    aggs = [F.min_by(F.col(_V + c), F.col(_O + c)).alias(c) for c in cols]
    if not aggs:
        return rollup.select(*keys).distinct()
    return rollup.groupBy(*keys).agg(*aggs)


def station_meta(rollup: DataFrame, cols) -> DataFrame:
    """First non-null value per (city_key, station_key), rolled up from the hours."""
    return _meta(rollup, ["city_key", "station_key"], cols)


def city_hour_meta(rollup: DataFrame, hour_col: str, cols) -> DataFrame:
    """D3: first non-null value per (city_key, hour), rolled up from the station-hours."""
    return _meta(rollup, ["city_key", hour_col], cols)


def first_non_null_by(df: DataFrame, keys, cols, order_cols) -> DataFrame:
    """D1 as a stand-alone aggregate over any frame."""
    return df.groupBy(*keys).agg(*[first_non_null(c, order_cols).alias(c) for c in cols])


def _coord_medians(df: DataFrame, keys, lat: str, lng: str) -> DataFrame:
    """Exact medians of both coordinates per key in one grouped quantile (unpivoted)."""
    from .splits import exact_median
    long = df.select(*keys, lat, lng).unpivot(list(keys), [lat, lng], "_coord", "_value")
    q = exact_median(long, list(keys) + ["_coord"], "_value", "_q")
    return q.groupBy(*keys).agg(F.max(F.when(F.col("_coord") == lat, F.col("_q"))).alias(lat),
                                F.max(F.when(F.col("_coord") == lng, F.col("_q"))).alias(lng))


def station_median_coords(df: DataFrame, station_col: str = "start_station_id",
                          lat: str = "start_lat", lng: str = "start_lng") -> DataFrame:
    """Exact median lat/lng per station (a station without coordinates keeps NULLs).

    Coordinates are continuous, so a value->count map per station (Spark's exact
    ``median``) would grow with a busy station's rides; ``exact_median`` keeps the
    state bounded by bucket refinement."""
    ids = df.select(station_col).distinct()
    return ids.join(_coord_medians(df, [station_col], lat, lng), station_col, "left")


def city_centroid(df: DataFrame, lat: str = "start_lat", lng: str = "start_lng",
                  override: tuple[float, float] | None = None) -> DataFrame:
    """One-row centroid: exact median of all ride coordinates, or a user override."""
    if override is not None:
        return df.sparkSession.range(1).select(F.lit(float(override[0])).alias("lat0"),
                                               F.lit(float(override[1])).alias("lng0"))
    m = _coord_medians(df.withColumn("_all", F.lit(0)), ["_all"], lat, lng)
    return m.select(F.col(lat).alias("lat0"), F.col(lng).alias("lng0"))


def coverage_pct(df: DataFrame, cols) -> DataFrame:
    """Percentage of rows where each column is present."""
    return df.agg(*[(F.avg(F.col(c).isNotNull().cast("double")) * 100).alias(f"{c}_coverage_pct")
                    for c in cols])
