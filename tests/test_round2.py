"""Counter-examples of earlier rounds: medians, ride coordinates, unusable predictions."""
import numpy as np
import pytest

from dockhour import session
from dockhour.operators import aggregates as A
from dockhour.operators import enrich as H
from dockhour.operators import scoring as SC
from dockhour.operators.splits import exact_median

SF001 = "/root/testdata/sf0.001"


def test_median_of_values_that_differ_in_the_seventh_place(spark):
    v = [38.032, 38.032, 38.0320003, 38.0320003, 38.0320003]
    df = spark.createDataFrame([(1, x) for x in v], "g int, v double")
    assert exact_median(df, ["g"], "v").first()["v"] == 38.0320003


@pytest.mark.parametrize("places", [3, 5, 7])
def test_medians_equal_numpy(spark, places):
    rng = np.random.default_rng(places)
    rows = []
    for g in range(40):
        base = round(float(rng.uniform(-120, 120)), 3)
        for _ in range(int(rng.integers(1, 30))):
            rows.append((g, round(base + float(rng.integers(-4, 5)) * 10.0 ** -places, places)))
    got = {r.g: r.v for r in exact_median(spark.createDataFrame(rows, "g int, v double"),
                                          ["g"], "v").collect()}
    for g in range(40):
        assert got[g] == float(np.median([v for k, v in rows if k == g]))


def test_station_medians_keep_stations_without_coordinates(spark):
    df = spark.createDataFrame([("a", 1.5, 2.5), ("a", 2.5, 2.5), ("b", None, None)],
                               "start_station_id string, start_lat double, start_lng double")
    got = {r.start_station_id: (r.start_lat, r.start_lng)
           for r in A.station_median_coords(df).collect()}
    assert got == {"a": (2.0, 2.5), "b": (None, None)}


def test_rides_keep_their_coordinates(spark):
    rows = [(1, "2024-01-02 03:04:05", "s", 38.80, -77.10), (2, "2024-01-02 04:04:05", "s", 38.82, -77.12),
            (3, "2024-01-02 05:04:05", None, 38.81, -77.11), (4, "2024-01-02 05:04:05", None, None, None)]
    raw = spark.createDataFrame(rows, "rental_id long, started_at string, start_station_id string, "
                                      "start_lat double, start_lng double")
    from dockhour.sources import testdata as TD
    layers = H.PoiLayers(TD.poi_elements(spark, SF001), TD.line_elements(spark, SF001),
                         TD.polygon_elements(spark, SF001))
    out = H.enrich_city(raw, None, layers).collect()
    got = sorted((r.start_lat, r.start_lng) for r in out if r.start_lat is not None)
    assert got == [(38.80, -77.10), (38.81, -77.11), (38.82, -77.12)]
    # both rides without a station have that station's features, the one without coordinates too
    far = {r.distance_to_city_center for r in out if r.start_station_id is None}
    assert len(far) == 1 and far != {None}


def labels(spark):
    return spark.createDataFrame([(1, "c", 2), (2, "c", 0), (3, "d", 1)], "id long, city string, demand long")


@pytest.mark.parametrize("rows", [
    [("other", 7, 1.0), ("other", 8, 1.0), ("other", 9, 1.0)],
    [("nan", 1, 1.0), ("nan", 2, float("nan")), ("nan", 3, 1.0)],
    [("null", 1, 1.0), ("null", 2, None), ("null", 3, 1.0)],
    [("short", 1, 1.0), ("short", 3, 1.0)]])
def test_unusable_predictions_raise(spark, rows):
    good = [("good", 1, 2.0), ("good", 2, -1.0), ("good", 3, 1.0)]
    preds = spark.createDataFrame(good + rows, "model string, id long, prediction double")
    with pytest.raises(ValueError, match="no usable prediction"):
        SC.score_rows(labels(spark), preds)
    best, failed = SC.multi_model_leaderboard(labels(spark), preds)
    assert {r.model for r in best.collect()} == {"good"}
    assert {r.model for r in failed.collect()} == {rows[0][0]}


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.ensure_checkpoint_dir(Session())


def test_one_very_long_edge_and_one_very_large_polygon(spark):
    from dockhour.operators import spatial as S
    st = spark.range(10_000).selectExpr("concat('s', id) AS station_id", "(id % 100) * 300.0 AS x",
                                        "floor(id / 100) * 300.0 AS y")
    edge = spark.createDataFrame([(1, -500_000.0, 150.0, 500_000.0, 150.0)],
                                 "element_id long, x0 double, y0 double, x1 double, y1 double")
    got = S.line_length_in_radius(st, edge, 500.0, "m").groupBy("m").count().orderBy("m").collect()
    # chords of the line at 150, 150, 450 and 450 m from the rows of stations next to it
    want = {0.0: 9700, round(2 * (500 ** 2 - 450 ** 2) ** 0.5, 1): 100,
            round(2 * (500 ** 2 - 150 ** 2) ** 0.5, 1): 200}
    assert {r.m: r["count"] for r in got} == want
    c = [(-1e6, -1e6), (1e6, -1e6), (1e6, 1e6), (-1e6, 1e6)]
    ring = [(1, *a, *b) for a, b in zip(c, c[1:] + c[:1], strict=True)]
    poly = spark.createDataFrame(ring, edge.schema)
    areas = S.polygon_area_in_radius(st, poly, 500.0, "a").select("a").distinct().collect()
    assert [r.a for r in areas] == [round(np.pi * 500 ** 2, 1)]
