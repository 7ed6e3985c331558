"""Grids, demand and the targets builder (§2.14 items 4, 7, 18; properties of SURVEY §5)."""
import datetime as dt

from pyspark.sql import functions as F

from dockhour.operators import aggregates as A
from dockhour.operators import grid as G
from dockhour.operators.keys import key_rides
from dockhour.plans.table import station_hour_table
from dockhour.plans.targets import station_hour_targets
from dockhour.sources import testdata as TD

H = "target_hour_start"
SCHEMA = "ride_id long, city string, start_station_id string, started_at timestamp_ntz, temperature_2m double"


def _rides(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _windows(spark, rows):
    k = key_rides(_rides(spark, rows), H)
    return G.station_windows(A.hour_rollup(k, H, [], [], ["ride_id"]), H)


def test_padding_splits_missing_hours(spark):
    rows = [(1, "c", "1", dt.datetime(2024, 3, 10, 10, 20), None),
            (2, "c", "2", dt.datetime(2024, 3, 1, 0, 0), None),     # city bounds far away
            (3, "c", "2", dt.datetime(2024, 3, 20, 0, 0), None)]
    g = G.grid_active_window(_windows(spark, rows), H, 0, 0, 72).filter(F.col("station_key") == "1")
    r = g.agg(F.min(H), F.max(H), F.count("*")).first()
    assert r[2] == 72
    assert r[0] == dt.datetime(2024, 3, 10, 10) - dt.timedelta(hours=35)
    assert r[1] == dt.datetime(2024, 3, 10, 10) + dt.timedelta(hours=36)


def test_padding_clipped_to_city_start(spark):
    rows = [(1, "c", "1", dt.datetime(2024, 3, 10, 10, 20), None),
            (2, "c", "2", dt.datetime(2024, 3, 10, 9, 0), None),
            (3, "c", "2", dt.datetime(2024, 3, 20, 0, 0), None)]
    g = G.grid_active_window(_windows(spark, rows), H, 0, 0, 72).filter(F.col("station_key") == "1")
    r = g.agg(F.min(H), F.count("*")).first()
    assert r[0] == dt.datetime(2024, 3, 10, 9) and r[1] == 38


def test_daytime_only_table_has_zero_rows(spark):
    rows = [(1, "c", "1", dt.datetime(2024, 3, 10, 5, 10), None),
            (2, "c", "1", dt.datetime(2024, 3, 10, 23, 10), None)]
    t = station_hour_table(_rides(spark, rows), ["ride_id"])
    r = t.agg(F.count("*"), F.sum("demand"), F.min(F.hour("ts")), F.max(F.hour("ts"))).first()
    assert tuple(r) == (17, 0, 6, 22)


def test_city_hour_without_rides_has_null_weather(spark):
    rows = [(1, "c", "1", dt.datetime(2024, 3, 10, 10, 10), 5.0),
            (2, "c", "1", dt.datetime(2024, 3, 10, 12, 10), 7.0)]
    out = station_hour_targets(_rides(spark, rows), ["ride_id"], min_window=1, max_eval_hours_by_city=None)
    got = {r[H]: (r.demand, r.temperature_2m) for r in out.labels.collect()}
    assert got[dt.datetime(2024, 3, 10, 11)] == (0, None)
    assert got[dt.datetime(2024, 3, 10, 10)] == (1, 5.0)


def test_first_non_null_follows_order(spark):
    rows = [(3, "c", "1", dt.datetime(2024, 3, 10, 10, 1), 9.0),
            (1, "c", "1", dt.datetime(2024, 3, 10, 10, 2), None),
            (2, "c", "1", dt.datetime(2024, 3, 10, 10, 3), 4.0)]
    k = key_rides(_rides(spark, rows), H)
    r = A.hour_rollup(k, H, [], ["temperature_2m"], ["ride_id"])
    assert A.city_hour_meta(r, H, ["temperature_2m"]).first().temperature_2m == 4.0


def test_full_grid_properties(spark):
    r = TD.rides(spark, "/root/testdata/sf0.001")
    k = key_rides(r, H)
    roll = A.hour_rollup(k, H, [], [], ["ride_id"])
    grid = G.grid_full(G.station_windows(roll, H), H)
    filled = G.zero_fill_demand(grid, A.demand_counts(roll, H), H)
    # unique keys, gap-free per station, and all rides land on an unfiltered full grid
    assert filled.count() == filled.select("city_key", "station_key", H).distinct().count()
    span = filled.groupBy("city_key", "station_key").agg(
        F.count("*").alias("n"), ((F.unix_timestamp(F.max(H).cast("timestamp"))
                                   - F.unix_timestamp(F.min(H).cast("timestamp"))) / 3600 + 1).alias("w"))
    assert span.filter(F.col("n") != F.col("w")).count() == 0
    assert filled.agg(F.sum("demand")).first()[0] == r.count()


def test_dense_ids_are_sorted_positions(spark):
    r = TD.rides(spark, "/root/testdata/sf0.001")
    out = station_hour_targets(r, ["ride_id"], max_eval_hours_by_city=TD.TESTDATA_EVAL_CAPS)
    rows = out.labels.select("id", "city_key", "station_key", H).collect()
    ids = [x.id for x in sorted(rows, key=lambda x: (x.city_key, x.station_key, x[H]))]
    assert ids == list(range(len(rows)))


def test_cap_keeps_all_stations_at_selected_hours(spark):
    r = TD.rides(spark, "/root/testdata/sf0.001")
    k = key_rides(r, H)
    w = G.station_windows(A.hour_rollup(k, H, [], [], ["ride_id"]), H)
    g = G.grid_active_window(w, H, 0, 0, 72, keep_hours=range(6, 23))
    capped = G.cap_eval_hours(g, H, {"click": 10}, seed=42)
    hours = capped.filter(F.col("city_key") == "click").select(H).distinct().count()
    assert hours == 10
    sel = capped.filter(F.col("city_key") == "click").select(H).distinct()
    assert g.filter(F.col("city_key") == "click").join(sel, H).count() == capped.filter(
        F.col("city_key") == "click").count()
    assert capped.filter(F.col("city_key") != "click").count() == g.filter(F.col("city_key") != "click").count()
