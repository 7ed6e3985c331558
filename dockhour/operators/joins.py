"""Joins (J1-J7, J10).

No join here hints a broadcast blindly: metadata sides are aggregates whose
size is only known at runtime, so AQE (enabled by ``session.get_session``)
measures the finished stage and switches to a broadcast hash join when it is
under ``spark.sql.autoBroadcastJoinThreshold``, keeping the shuffle join
otherwise.  ``validated_join`` adds the cardinality check pandas' ``validate=``
performs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import NUMERIC_TEXT


class JoinValidationError(ValueError):
    pass


def assert_unique(df: DataFrame, keys, what: str = "right") -> None:
    """Raise if any key occurs twice (one aggregate, stops at the first duplicate)."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > 1).limit(1).collect())
    if dup:
        raise JoinValidationError(f"{what} side has duplicate keys {list(keys)}: {dup[0].asDict()}")


def validated_join(left: DataFrame, right: DataFrame, keys, how: str = "left",
                   validate: str = "many_to_one") -> DataFrame:
    """Join that fails on duplicate keys where the relationship forbids them."""
    if validate in ("one_to_one", "many_to_one"):
        assert_unique(right, keys, "right")
    if validate in ("one_to_one", "one_to_many"):
        assert_unique(left, keys, "left")
    return left.join(right, list(keys), how)


def join_station_meta(targets: DataFrame, smeta: DataFrame) -> DataFrame:
    """Many-to-one left join on (city_key, station_key)."""
    return targets.join(smeta, ["city_key", "station_key"], "left")


def join_city_hour(targets: DataFrame, chmeta: DataFrame, hour_col: str) -> DataFrame:
    """Many-to-one left join on (city_key, hour)."""
    return targets.join(chmeta, ["city_key", hour_col], "left")


def numeric_station_id(c) -> "F.Column":
    """Station id as an integer (lenient): ``'7'``, ``'7.0'``, ``' 7'`` -> 7; text -> NULL."""
    raw = F.regexp_replace(F.col(c).cast("string"), r"^\s+|\s+$", "")
    d = F.when(raw.rlike(NUMERIC_TEXT), raw.try_cast("double"))
    return F.when((d % 1) == 0, d.try_cast("bigint"))


def join_station_features(rides: DataFrame, features: DataFrame,
                          id_col: str = "start_station_id") -> DataFrame:
    """Left join on the numeric station id (no city key); lat/lng renamed."""
    feats = (features.withColumnsRenamed({"lat": "start_lat", "lng": "start_lng"})
             .withColumn(id_col, numeric_station_id(id_col)))
    return rides.withColumn(id_col, numeric_station_id(id_col)).join(feats, id_col, "left")


def join_weather_hour(rides: DataFrame, weather: DataFrame, hour_col: str = "hour_ts") -> DataFrame:
    """Left join hourly weather on the hour key."""
    return rides.join(weather, hour_col, "left")


def inner_grid_meta(windows: DataFrame, smeta: DataFrame) -> DataFrame:
    """Keep station windows that have metadata (one-to-one)."""
    return smeta.select("city_key", "station_key").join(windows, ["city_key", "station_key"], "inner")


def ids_match(a: DataFrame, b: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids present in only one table (empty result = exact set equality)."""
    ia, ib = a.select(id_col).distinct(), b.select(id_col).distinct()
    return (ia.join(ib, id_col, "left_anti").withColumn("only_in", F.lit("left"))
            .unionByName(ib.join(ia, id_col, "left_anti").withColumn("only_in", F.lit("right"))))


def require_ids_match(a: DataFrame, b: DataFrame, id_col: str = "id") -> None:
    if ids_match(a, b, id_col).limit(1).count():
        raise ValueError("some ids occur only among the targets or only among the labels")
