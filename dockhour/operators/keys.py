"""Keyed rides: city_key, station_key and the floored hour."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import city_key, normalize_station_id, resolve_hour
from ..schemas import ALL_CITIES_BUILDER

BUILDER_TIME_PRECEDENCE = ("hour_ts", "started_at")
TABLE_TIME_PRECEDENCE = ("hour_ts", "target_hour_start", "started_at", ("date", "hour"))


def key_rides(df: DataFrame, hour_name: str = "target_hour_start",
              precedence=BUILDER_TIME_PRECEDENCE, station_col: str | None = "start_station_id",
              city_col: str = "city", absent_city: str = ALL_CITIES_BUILDER,
              strict: bool = False) -> DataFrame:
    """Add ``city_key``, ``station_key`` and ``hour_name`` (hour floor).

    ``strict=True`` follows the targets builder: any row without a usable time
    raises (one aggregate job).  ``strict=False`` follows the training table:
    such rows are dropped.
    """
    if station_col is None:
        station_col = "start_station_id" if "start_station_id" in df.columns else "station_id"
    if station_col not in df.columns:
        raise ValueError(f"Missing required station column: {station_col}")
    out = df.withColumns({
        "city_key": city_key(df.columns, city_col, absent_city),
        "station_key": normalize_station_id(station_col),
        hour_name: resolve_hour(df, precedence),
    })
    return reject_bad_timestamps(out, hour_name, strict)


def reject_bad_timestamps(df: DataFrame, hour_name: str, strict: bool) -> DataFrame:
    """B4.  strict: a row without a usable time fails the job (``raise_error`` inside
    the projection, so no extra pass over the rides); else such rows are dropped."""
    h = F.col(hour_name)
    if strict:
        msg = F.lit("rows have invalid/missing timestamps (first bad row shown): ")
        bad = F.raise_error(F.concat(msg, F.to_json(F.struct(*[F.col(c) for c in df.columns[:6]]))))
        return df.withColumn(hour_name, F.when(h.isNull(), bad).otherwise(h).cast("timestamp_ntz"))
    return df.filter(h.isNotNull())
