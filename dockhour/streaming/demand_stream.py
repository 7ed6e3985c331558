"""Rides per (city, station, hour) over a stream of rides.

Same keys as the batch operator (``operators.keys``), counted in 1-hour
event-time windows.  The watermark bounds the state: an hour is final once the
stream's event time has passed its end by ``lateness``, and rides arriving
later than that are dropped by Spark (late data).  Append mode emits each
hour once; ``foreachBatch`` writes it idempotently per batch id.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import city_key, normalize_station_id


def demand_counts_stream(rides: DataFrame, time_col: str = "started_at", lateness: str = "2 hours",
                         station_col: str = "start_station_id", city_col: str = "city") -> DataFrame:
    """Streaming D0: ``city_key, station_key, target_hour_start, demand``."""
    t = F.col(time_col).cast("timestamp")            # event time for the watermark
    keyed = rides.select(city_key(rides.columns, city_col).alias("city_key"),
                         normalize_station_id(station_col).alias("station_key"),
                         t.alias("_event_time")).filter(F.col("_event_time").isNotNull())
    counts = (keyed.withWatermark("_event_time", lateness)
              .groupBy("city_key", "station_key", F.window("_event_time", "1 hour"))
              .agg(F.count(F.lit(1)).alias("demand")))
    return counts.select("city_key", "station_key",
                         F.col("window.start").cast("timestamp_ntz").alias("target_hour_start"), "demand")


def start_demand_sink(counts: DataFrame, path: str, checkpoint: str, trigger_available_now: bool = True):
    """Append finished hours to Parquet; each micro-batch writes its own folder
    (``batch_id=``) with overwrite, so a replayed batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start()
