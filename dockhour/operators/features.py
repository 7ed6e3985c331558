"""Feature builders and missingness rules.

All columns are plain expressions over the station-hour table; nothing
leaves the JVM.  MLlib trees reject NaN, so missing values stay NULL here and
the model pipeline imputes them (see ``dockhour.ml``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.keys import nan_to_null, numeric_coerce
from ..functions.time import cyclical_time
from ..schemas import (CALENDAR_FLAGS, POI_COLS, POI_PRESENCE_COLS, STATION_META_COLS,
                       TE_COLS, WEATHER_COLS, present)

RAIL = "distance_to_nearest_rail_station"


def _num(df: DataFrame, c: str) -> Column:
    """Numeric view of a column: numbers as double with NaN -> NULL, text parsed leniently."""
    if c not in df.columns:
        return F.lit(None).cast("double")
    if isinstance(df.schema[c].dataType, T.NumericType):
        return nan_to_null(F.col(c).cast("double"))
    return numeric_coerce(c)


def apply_missingness(df: DataFrame) -> DataFrame:
    """rail == -1 -> NULL; when every present presence-POI value is 0 or missing,
    all of them become NULL (an uninformative all-zero station record)."""
    repl = {}
    if RAIL in df.columns:
        rail = _num(df, RAIL)
        repl[RAIL] = F.when(rail != -1, rail)
    pres = present(df.columns, POI_PRESENCE_COLS)
    if pres:
        all_zero = F.lit(True)
        for c in pres:
            all_zero = all_zero & (F.coalesce(_num(df, c), F.lit(0.0)) == 0)
        for c in pres:
            repl[c] = F.when(~all_zero, _num(df, c))
    return df.withColumns(repl) if repl else df


def category_missingness(df: DataFrame) -> dict[str, Column]:
    """miss_weather (all weather missing), miss_station (all presence POI missing
    after B9), miss_calendar (any flag missing); a group with no columns counts as missing.
    Expects ``apply_missingness`` to have run."""
    def all_null(cols):
        if not cols:
            return F.lit(1)
        cond = F.lit(True)
        for c in cols:
            cond = cond & _num(df, c).isNull()
        return cond.cast("int")

    def any_null(cols):
        if not cols:
            return F.lit(1)
        cond = F.lit(False)
        for c in cols:
            cond = cond | _num(df, c).isNull()
        return cond.cast("int")

    return {
        "miss_weather": all_null(present(df.columns, WEATHER_COLS)),
        "miss_calendar": any_null(present(df.columns, CALENDAR_FLAGS)),
        "miss_station": all_null(present(df.columns, POI_PRESENCE_COLS)),
    }


def time_features(df: DataFrame, ts: str = "ts") -> dict[str, Column]:
    """B7 (+B6): cyclical hour/weekday, raw hour, weekday, weekend flag, month, day of year."""
    hour = F.col("hour") if "hour" in df.columns else F.hour(ts)
    wd = F.col("weekday") if "weekday" in df.columns else F.weekday(ts)
    cyc = cyclical_time(ts, hour, wd)
    wkend = (F.col("is_weekend") if "is_weekend" in df.columns
             else F.when(wd >= 5, 1).otherwise(0))
    return {"hour_sin": cyc["hour_sin"], "hour_cos": cyc["hour_cos"],
            "dow_sin": cyc["dow_sin"], "dow_cos": cyc["dow_cos"],
            "hour": hour.cast("double"), "weekday": wd.cast("double"),
            "is_weekend": wkend.cast("double"), "month": cyc["month"].cast("double"),
            "day_of_year": cyc["day_of_year"].cast("double")}


def feature_groups() -> dict[str, list[str]]:
    """The column sets of the four feature matrices."""
    tf = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "hour", "weekday", "is_weekend",
          "month", "day_of_year"]
    return {
        "weather": list(WEATHER_COLS),
        "calendar": tf + list(CALENDAR_FLAGS),
        "station": list(POI_COLS),
        "no_identity": tf + list(CALENDAR_FLAGS) + list(WEATHER_COLS) + list(POI_COLS),
        "baseline": tf[:7] + list(WEATHER_COLS) + list(CALENDAR_FLAGS) + list(STATION_META_COLS)
        + list(TE_COLS),
    }


def build_features(df: DataFrame, group: str, keep=(), ts: str = "ts") -> DataFrame:
    """Project one feature matrix (plus ``keep`` columns such as keys / label)."""
    cols = feature_groups()[group]
    src = apply_missingness(df) if group in ("station", "no_identity") else df
    tf = time_features(src, ts)
    out = [F.col(k) for k in keep]
    for c in cols:
        if c in tf:
            out.append(tf[c].alias(c))
        elif c in src.columns:
            out.append(_num(src, c).alias(c))
        else:
            out.append(F.lit(None).cast("double").alias(c))
    return src.select(*out)


def fallback_median(train: DataFrame, ts: str = "ts") -> tuple[DataFrame, Column]:
    """Median demand per (weekday, hour) and the global median (scalar subquery).

    Exact ``median`` keeps a value->count map per group; demand values are small
    counts, so the map stays tiny whatever the row count.
    """
    by = (train.groupBy(F.weekday(ts).alias("_w"), F.hour(ts).alias("_h"))
          .agg(F.median(F.col("demand").cast("double")).alias("fallback_median")))
    glob = train.select(F.median(F.col("demand").cast("double"))).scalar()
    return by, glob


def cold_start_fallback(df: DataFrame, by: DataFrame, glob: Column, pred_col: str = "prediction",
                        ts: str = "ts") -> DataFrame:
    """M3 fallback part: rows with all three masks set get the weekday x hour median
    (else the global median); predictions are clipped at 0."""
    j = df.join(by, (F.weekday(ts) == by["_w"]) & (F.hour(ts) == by["_h"]), "left")
    cold = (F.col("miss_weather") + F.col("miss_calendar") + F.col("miss_station")) == 3
    fb = F.coalesce(F.col("fallback_median"), glob)
    return (j.withColumn(pred_col, F.greatest(F.lit(0.0), F.when(cold, fb).otherwise(F.col(pred_col))))
            .drop("_w", "_h", "fallback_median"))
