"""Splits, pooling, weights, encodings, scoring (§2.14 items 8, 10-12, 16, 17; FIXTURES C)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from dockhour.operators import encoding as TE
from dockhour.operators import features as FE
from dockhour.operators import pooling as U
from dockhour.operators import scoring as SC
from dockhour.operators import splits as P


def test_quantile_cut_interpolates(spark):
    rows = [("c", dt.datetime(2024, 1, 1, h)) for h in range(4)] + [(None, dt.datetime(2024, 1, 1, 1))]
    df = spark.createDataFrame(rows, "city string, started_at timestamp_ntz")
    out, cuts = P.temporal_split_rides(df)
    assert cuts.first().cutoff == dt.datetime(2024, 1, 1, 2, 24)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 3, "val": 1}                 # the NULL-city ride is in neither


def test_exact_quantile_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 10 ** 13, 500)
    df = spark.createDataFrame([("g", int(v)) for v in vals], "g string, v long")
    q = P.exact_quantile(df, ["g"], "v", 0.8).first().q
    assert abs(q - np.quantile(vals, 0.8)) <= 1


def test_official_row_wins_even_with_zero(spark):
    off = spark.createDataFrame([("c", "1", dt.datetime(2024, 1, 1, 10), 0)],
                                "city_key string, station_key string, ts timestamp_ntz, demand long")
    sup = spark.createDataFrame([("c", "1", dt.datetime(2024, 1, 1, 10), 5),
                                 ("c", "1", dt.datetime(2024, 1, 1, 11), 2)],
                                "city_key string, station_key string, ts timestamp_ntz, demand long")
    d = U.dedup_prefer_official(U.pool_sources(off, [sup])).orderBy("ts").collect()
    assert [(r.demand, r.is_supplementary) for r in d] == [(0, False), (2, True)]


def test_city_balanced_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "city_key string")
    w = sorted(r.weight for r in P.city_balanced_weights(df).collect())
    assert w == pytest.approx([2 / 3, 2 / 3, 2 / 3, 2.0])
    assert sum(w) / 4 == pytest.approx(1.0)


def test_leak_guard(spark):
    df = spark.createDataFrame([("x", "train"), ("h", "val")], "city_key string, split string")
    with pytest.raises(AssertionError):
        P.leak_guard(df, "h")
    with pytest.raises(ValueError):
        P.leak_guard(df, "missing")


def test_folds_deterministic_and_balanced(spark):
    df = spark.range(2000).withColumn("k", F.col("id").cast("string"))
    a = P.kfold_assign(df, ["k"], 5).groupBy("fold").count().collect()
    b = P.kfold_assign(df, ["k"], 5).groupBy("fold").count().collect()
    assert sorted(a) == sorted(b) and len(a) == 5 and min(r["count"] for r in a) > 300


def _table(spark):
    rows = [("c1", "1", 0, 2), ("c1", "1", 1, 4), ("c1", "2", 0, 0), ("c2", "9", 0, 6)]
    return spark.createDataFrame(rows, "city_key string, station_key string, how int, demand long")


def test_te_fallbacks(spark):
    enc = TE.te_fit(_table(spark))
    ev = spark.createDataFrame([("c1", "7", 0), ("zz", "7", 3), ("c1", "1", 5)],
                               "city_key string, station_key string, how int")
    got = {(r.city_key, r.station_key): r for r in TE.te_transform(ev, enc).collect()}
    unseen_station = got[("c1", "7")]
    assert unseen_station.te_station == unseen_station.te_city == pytest.approx(2.0)
    assert unseen_station.te_station_how == pytest.approx(2.0)
    unseen_city = got[("zz", "7")]
    assert [unseen_city.te_city, unseen_city.te_city_how, unseen_city.te_station,
            unseen_city.te_station_how] == pytest.approx([3.0] * 4)
    known = got[("c1", "1")]
    assert known.te_station == pytest.approx(3.0) and known.te_station_how == pytest.approx(3.0)


def test_te_oof_single_row_key_falls_back(spark):
    rows = [("c1", "1", 0, 2, 0), ("c1", "1", 1, 4, 1), ("c1", "2", 0, 0, 0), ("c2", "9", 0, 6, 1)]
    t = spark.createDataFrame(rows, "city_key string, station_key string, how int, demand long, fold int")
    out = {(r.city_key, r.station_key, r.how): r for r in TE.te_oof(t).collect()}
    r = out[("c2", "9", 0)]          # nothing of c2 in fold 0: every level falls back to fold 0's mean
    assert (r.te_city, r.te_city_how, r.te_station, r.te_station_how) == (1.0, 1.0, 1.0, 1.0)
    r = out[("c1", "1", 1)]          # other folds: station 1 has one row (2), city c1 rows (2, 0)
    assert (r.te_station, r.te_city, r.te_station_how) == (2.0, 1.0, 2.0)   # (1, how 1) unseen -> station


def test_missingness_rules(spark):
    cols = ["bike_lane_length_500m", "park_area_500m", "university_count_1000m", "office_poi_count_1000m",
            "retail_poi_count_1000m", "restaurant_cafe_count_500m", "transit_stop_count_500m",
            "distance_to_nearest_rail_station", "distance_to_city_center"]
    df = spark.createDataFrame([tuple([0.0] * 7 + [-1.0, 500.0])], ", ".join(f"{c} double" for c in cols))
    r = FE.apply_missingness(df).first()
    assert all(r[c] is None for c in cols[:8]) and r.distance_to_city_center == 500.0
    m = FE.category_missingness(FE.apply_missingness(df))
    got = FE.apply_missingness(df).select(*[v.alias(k) for k, v in m.items()]).first()
    assert (got.miss_weather, got.miss_station, got.miss_calendar) == (1, 1, 1)


def test_cold_start_uses_global_median(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 3), 1, 1, 1, 9.0), (dt.datetime(2024, 1, 1, 10), 0, 1, 1, -2.0)],
                               "ts timestamp_ntz, miss_weather int, miss_calendar int, miss_station int, prediction double")
    by = spark.createDataFrame([(0, 10, 4.0)], "_w int, _h int, fallback_median double")
    out = sorted(FE.cold_start_fallback(df, by, F.lit(1.5)).collect(), key=lambda r: r.ts)
    assert [r.prediction for r in out] == [0.0, 1.5]


def test_scoring_clip_and_overall_negatives(spark):
    labels = spark.createDataFrame([(0, "a", 0), (1, "b", 3)], "id long, city string, demand long")
    preds = spark.createDataFrame([("m", 0, -2.0), ("m", 1, 1.0)], "model string, id long, prediction double")
    s = {r.city: r for r in SC.score_summary(SC.score_rows(labels, preds)).collect()}
    assert s["a"].mae == 0.0 and s["a"].negative_predictions_before_clipping is None
    assert s["OVERALL"].negative_predictions_before_clipping == 1 and s["OVERALL"].mae == 1.0
    with pytest.raises(ValueError):
        SC.score_rows(labels, preds.filter("id = 0"))


def test_blended_mae(spark):
    s = spark.createDataFrame([("m", "a", 1.0), ("m", "b", 0.5), ("m", "h", 2.0), ("m", "OVERALL", 9.0)],
                              "model string, city string, mae double")
    assert SC.blended_mae(s, "h").first().blended_mae == pytest.approx(1.166667, abs=1e-6)


def test_leaderboard_skips_failing_model(spark):
    labels = spark.createDataFrame([(0, "a", 1), (1, "a", 2)], "id long, city string, demand long")
    preds = spark.createDataFrame([("good", 0, 1.0), ("good", 1, 2.0), ("bad", 0, float("nan")), ("bad", 1, 1.0)],
                                  "model string, id long, prediction double")
    board, failures = SC.multi_model_leaderboard(labels, preds)
    assert {r.model for r in board.collect()} == {"good"}
    assert [r.model for r in failures.collect()] == ["bad"]
    with pytest.raises(RuntimeError):
        SC.multi_model_leaderboard(labels, preds.filter("model = 'bad'"))
