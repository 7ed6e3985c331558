"""EDA numbers and spatial joins against brute force / closed forms."""
import math

import numpy as np
import pytest

from dockhour.operators import eda as E
from dockhour.operators import spatial as S


def test_acf_lag2(spark):
    import datetime as dt
    counts = [1, 3, 2, 5, 4, 6]
    rows = []
    for i, n in enumerate(counts):
        rows += [("c", dt.datetime(2024, 1, 1, i))] * n
    df = spark.createDataFrame(rows, "city string, hour_ts timestamp_ntz")
    acf = {r.lag: r.acf for r in E.acf_hourly(df, 3).collect()}
    assert acf[2] == pytest.approx(0.942857, abs=1e-6)


def test_binned_box_edges(spark):
    import datetime as dt
    vals = [0, 1, 2, 3, 4, 5, 6, 12]
    rows = [("c", str(i), dt.datetime(2024, 1, 1, i), float(v), 0.0, 0.0) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "city string, start_station_id string, hour_ts timestamp_ntz, "
                                     "temperature_2m double, precipitation double, wind_speed_10m double")
    b = {r.bin: r for r in E.binned_box_stats(df).collect()}
    assert b[1].bin_lo == pytest.approx(-0.012) and b[1].bin_hi == pytest.approx(2.0)
    assert b[1].n == 3 and b[6].n == 1 and b[6].bin_hi == pytest.approx(12.0)


def _xy(spark, pts, name="p"):
    return spark.createDataFrame([(f"{name}{i}", float(x), float(y)) for i, (x, y) in enumerate(pts)],
                                 "station_id string, x double, y double")


def test_radius_count_and_nearest_vs_brute_force(spark):
    rng = np.random.default_rng(1)
    st = rng.uniform(0, 5000, (40, 2))
    pts = rng.uniform(0, 5000, (300, 2))
    sdf = _xy(spark, st, "s")
    pdf = spark.createDataFrame([(float(x), float(y)) for x, y in pts], "x double, y double")
    cnt = {r.station_id: r["count"] for r in S.radius_count(sdf, pdf, 500.0).collect()}
    near = {r.station_id: r.distance for r in S.nearest_distance(sdf, pdf, levels=(100.0, 400.0, 1600.0, 1e7)).collect()}
    for i, (x, y) in enumerate(st):
        d = np.hypot(pts[:, 0] - x, pts[:, 1] - y)
        assert cnt[f"s{i}"] == int((d <= 500).sum())
        assert near[f"s{i}"] == pytest.approx(round(d.min(), 1), abs=0.051)


def test_nearest_none_is_minus_one(spark):
    sdf = _xy(spark, [(0, 0)], "s")
    empty = spark.createDataFrame([], "x double, y double")
    assert S.nearest_distance(sdf, empty, levels=(10.0, 100.0)).first().distance == -1.0


def _edges(spark, segs, pid=None):
    return spark.createDataFrame([(pid if pid is not None else i, float(a), float(b), float(c), float(d))
                                  for i, (a, b, c, d) in enumerate(segs)],
                                 "element_id long, x0 double, y0 double, x1 double, y1 double")


def test_chord_length(spark):
    sdf = _xy(spark, [(0, 0)], "s")
    e = _edges(spark, [(-2000, 300, 2000, 300), (-2000, 0, 0, 0), (600, 0, 900, 0)])
    assert S.line_length_in_radius(sdf, e).first()[1] == pytest.approx(800.0 + 500.0)


def test_polygon_area_inside_and_around_disc(spark):
    sdf = _xy(spark, [(0, 0)], "s")
    big = [(-5000, -5000), (5000, -5000), (5000, 5000), (-5000, 5000), (-5000, -5000)]
    edges = [(a[0], a[1], b[0], b[1]) for a, b in zip(big, big[1:])]
    full = S.polygon_area_in_radius(sdf, _edges(spark, edges, 1)).first()[1]
    assert full == pytest.approx(math.pi * 500 ** 2, abs=0.1)
    half = [(0, -5000), (5000, -5000), (5000, 5000), (0, 5000), (0, -5000)]   # right half-plane box
    edges = [(a[0], a[1], b[0], b[1]) for a, b in zip(half, half[1:])]
    assert S.polygon_area_in_radius(sdf, _edges(spark, edges, 2)).first()[1] == pytest.approx(
        math.pi * 500 ** 2 / 2, abs=0.1)


def test_category_rules(spark):
    df = spark.createDataFrame([(1, {"cycleway": "lane"}), (2, {"cycleway": "shared"}), (3, {"shop": "x"})],
                               "element_id long, tags map<string,string>")
    got = {(r.element_id, r.category) for r in S.poi_category_match(df).collect()}
    assert got == {(1, "cycle"), (3, "retail")}
    got_local = {(r.element_id, r.category) for r in S.poi_category_match(df, S.LOCAL_RULES).collect()}
    assert (2, "cycle") in got_local
