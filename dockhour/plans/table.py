"""Rides -> labelled station-hour training table."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.time import time_parts
from ..session import cut_lineage
from ..operators import aggregates as A
from ..operators import grid as G
from ..operators.keys import TABLE_TIME_PRECEDENCE, key_rides
from ..schemas import (ALL_CITIES_TABLE, DEFAULT_KEEP_HOURS, STATION_META_COLS,
                       TABLE_CALENDAR_COLS, WEATHER_COLS, present)

TS = "ts"


def station_hour_table(rides: DataFrame, order_cols, keep_hours=DEFAULT_KEEP_HOURS,
                       materialize: bool = True) -> DataFrame:
    """Active-window daytime grid with true zeros, first-value weather/calendar per
    (city, hour) and station metadata per station, plus time parts.

    Rows without a usable time are dropped (not an error here).  The hour rollup
    is the only pass over the rides; it is checkpointed (``materialize``) because
    four consumers read it and the optimizer would otherwise push each one's
    projection down and re-aggregate the rides per consumer.
    """
    keyed = key_rides(rides, TS, TABLE_TIME_PRECEDENCE, station_col=None,
                      absent_city=ALL_CITIES_TABLE, strict=False)
    wcols = present(keyed.columns, WEATHER_COLS + TABLE_CALENDAR_COLS)
    mcols = present(keyed.columns, STATION_META_COLS)
    rollup = A.hour_rollup(keyed, TS, mcols, wcols, order_cols)
    if materialize:
        rollup = cut_lineage(rollup)
    windows = G.station_windows(rollup, TS)
    grid = G.grid_train_window(windows, TS, keep_hours)
    table = G.zero_fill_demand(grid, A.demand_counts(rollup, TS), TS)
    if wcols:
        table = table.join(A.city_hour_meta(rollup, TS, wcols), ["city_key", TS], "left")
    if mcols:
        table = table.join(A.station_meta(rollup, mcols), G.KEYS, "left")
    tp = time_parts(TS)
    return table.select("city_key", "station_key", TS, "demand", *wcols, *mcols,
                        F.col("city_key").alias("city"), tp["hour"].alias("hour"),
                        tp["weekday"].alias("weekday"), tp["is_weekend"].alias("is_weekend"),
                        tp["how"].alias("how"))
