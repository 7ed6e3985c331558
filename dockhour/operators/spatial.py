"""Spatial operators as Spark joins.

Everything is projected to local metres (spherical azimuthal equidistant
around the mean station position) and joined through square grid cells:

* radius count (J8): a station looks at its 3x3 neighbourhood of cells of
  side r, so every point within r is a candidate; the distance filter is exact.
* nearest distance (J9): the same join at growing cell sizes; a station is
  resolved at the first level whose neighbourhood holds a point within one
  cell side (then the true nearest point is among the candidates).  Only
  unresolved stations go to the next level; the level loop runs on the driver
  but moves no data there.
* length / area inside a disc (G1, G2): each edge is listed in every cell its
  bounding box (grown by r) touches; per (station, edge) the clipped length or
  the signed area of triangle(centre, edge) ∩ disc has a closed form, so no
  geometry library and no Python UDF is needed.  Polygon areas are summed per
  polygon and made absolute, then overlapping parks add up.  Only simple rings
  are supported (the reference repairs invalid rings first).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import aeqd_xy

# FIXED VALUES: category tag rules (default rule set and the local-extract variant).
POI_RULES = {
    "university": {"amenity": ["university"]},
    "office": {"office": True},
    "retail": {"shop": True},
    "food": {"amenity": ["restaurant", "cafe"]},
    "transit": {"highway": ["bus_stop"], "railway": ["tram_stop"], "public_transport": ["platform"]},
    "rail": {"railway": ["station"]},
    "park": {"leisure": ["park", "garden", "nature_reserve", "common"],
             "landuse": ["recreation_ground", "grass", "meadow"]},
    "cycle": {"highway": ["cycleway"], "cycleway": "lane|track|opposite",
              "cycleway:left": "lane|track", "cycleway:right": "lane|track",
              "cycleway:both": "lane|track", "bicycle": ["designated"]},
}
LOCAL_RULES = {**POI_RULES, "cycle": {"highway": ["cycleway"], "cycleway": True,
                                      "bicycle": ["designated"]}}


def _tag_match(tags: Column, key: str, rule) -> Column:
    v = tags.getItem(key)
    if rule is True:
        return v.isNotNull()
    if isinstance(rule, str):                    # regular-expression rule
        return v.isNotNull() & v.rlike(rule)
    return v.isin(list(rule))


def poi_category_match(elements: DataFrame, rules: dict = POI_RULES, tags_col: str = "tags") -> DataFrame:
    """One row per (element, matching category); an element may match several."""
    tags = F.col(tags_col)
    cats = []
    for cat, tag_rules in rules.items():
        cond = F.lit(False)
        for key, rule in tag_rules.items():
            cond = cond | F.coalesce(_tag_match(tags, key, rule), F.lit(False))
        cats.append(F.when(cond, F.lit(cat)))
    arr = F.filter(F.array(*cats), lambda c: c.isNotNull())
    return elements.withColumn("category", F.explode(arr))


def elements_to_points(elements: DataFrame) -> DataFrame:
    """Own lat/lon, else the way's centre; elements with neither are dropped."""
    lat = F.coalesce(F.col("lat"), F.col("center.lat"))
    lon = F.coalesce(F.col("lon"), F.col("center.lon"))
    return elements.withColumns({"lat": lat, "lon": lon}).filter(lat.isNotNull() & lon.isNotNull()).drop("center")


def elements_to_edges(elements: DataFrame, min_points: int = 2) -> DataFrame:
    """One row per consecutive point pair of ``geometry`` (``min_points`` = 2 for
    lines, 3 for polygons); shorter geometries are skipped.  Narrow: no window."""
    g = F.col("geometry")
    ok = elements.filter(F.size(g) >= min_points)
    pairs = F.transform(F.sequence(F.lit(1), F.size(g) - 1),
                        lambda i: F.struct(i.alias("seq"), g[i - 1].alias("p0"), g[i].alias("p1")))
    e = ok.select(*[c for c in ok.columns if c != "geometry"], F.explode(pairs).alias("_e"))
    return e.select(*[c for c in ok.columns if c != "geometry"], F.col("_e.seq").alias("seq"),
                    F.col("_e.p0.lat").alias("lat0"), F.col("_e.p0.lon").alias("lon0"),
                    F.col("_e.p1.lat").alias("lat1"), F.col("_e.p1.lon").alias("lon1"))


def tile_stations(stations: DataFrame, tile: float = 0.035, margin: float = 0.013,
                  lat: str = "lat", lng: str = "lng") -> DataFrame:
    """H9: stations grouped by a ``tile``-degree tile (half-even rounding), with the
    tile's station bounding box grown by ``margin`` degrees."""
    st = stations.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    st = st.withColumns({"gx": F.rint(F.col(lat) / tile).cast("int"), "gy": F.rint(F.col(lng) / tile).cast("int")})
    return st.groupBy("gx", "gy").agg(
        F.count(F.lit(1)).alias("stations"),
        (F.min(lat) - margin).alias("south"), (F.min(lng) - margin).alias("west"),
        (F.max(lat) + margin).alias("north"), (F.max(lng) + margin).alias("east"))


# --- projection ------------------------------------------------------------------

def projection_centre(stations: DataFrame, lat: str = "lat", lng: str = "lng") -> tuple[Column, Column]:
    """Mean station position: a one-row aggregate read once and used as two literals
    (a scalar subquery would be re-run by every expression that uses it)."""
    row = stations.agg(F.avg(lat).alias("lat0"), F.avg(lng).alias("lng0")).first()
    return F.lit(row["lat0"]), F.lit(row["lng0"])


def project(df: DataFrame, lat: str, lng: str, lat0: Column, lng0: Column, x="x", y="y") -> DataFrame:
    px, py = aeqd_xy(lat, lng, lat0, lng0)
    return df.withColumns({x: px, y: py})


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size))).cast("bigint")


def _neighbourhood(size: float, reach: int = 1) -> Column:
    offs = list(range(-reach, reach + 1))
    return F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                               for dx in offs for dy in offs]))


# --- J8 / J9 ------------------------------------------------------------------------

def radius_count(stations_xy: DataFrame, points_xy: DataFrame, radius: float,
                 out: str = "count") -> DataFrame:
    """Points within ``radius`` metres of each station (0 when none).

    ``stations_xy``: station_id, x, y.  ``points_xy``: x, y (one category)."""
    pts = points_xy.select(_cell(F.col("x"), radius).alias("cx"), _cell(F.col("y"), radius).alias("cy"),
                           F.col("x").alias("px"), F.col("y").alias("py"))
    st = stations_xy.filter(F.col("x").isNotNull())
    cand = st.select("station_id", "x", "y", _neighbourhood(radius).alias("o")).select(
        "station_id", "x", "y", (_cell(F.col("x"), radius) + F.col("o.dx")).alias("cx"),
        (_cell(F.col("y"), radius) + F.col("o.dy")).alias("cy"))
    dx, dy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
    d2 = dx * dx + dy * dy
    hits = (cand.join(pts, ["cx", "cy"]).filter(d2 <= F.lit(float(radius) * float(radius)))
            .groupBy("station_id").agg(F.count(F.lit(1)).alias(out)))
    return (stations_xy.select("station_id").join(hits, "station_id", "left")
            .withColumn(out, F.when(F.col(out).isNotNull(), F.col(out)).otherwise(F.lit(0)).cast("bigint")))


NEAREST_LEVELS = (500.0, 2000.0, 8000.0, 32000.0, 128000.0, 512000.0, 2048000.0, 20037508.0)


def nearest_distance(stations_xy: DataFrame, points_xy: DataFrame, out: str = "distance",
                     levels=NEAREST_LEVELS, none_value: float = -1.0) -> DataFrame:
    """Distance to the closest point, rounded half-even to 0.1 m; ``none_value`` when
    there is no point at all.  Exact: see the module docstring."""
    from ..session import cut_lineage
    found = None
    todo = stations_xy.filter(F.col("x").isNotNull()).select("station_id", "x", "y")
    for size in levels:
        pts = points_xy.select(_cell(F.col("x"), size).alias("cx"), _cell(F.col("y"), size).alias("cy"),
                               F.col("x").alias("px"), F.col("y").alias("py"))
        cand = todo.select("station_id", "x", "y", _neighbourhood(size).alias("o")).select(
            "station_id", (_cell(F.col("x"), size) + F.col("o.dx")).alias("cx"),
            (_cell(F.col("y"), size) + F.col("o.dy")).alias("cy"), "x", "y")
        ddx, ddy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
        d = F.sqrt(ddx * ddx + ddy * ddy)
        best = (cand.join(pts, ["cx", "cy"]).groupBy("station_id").agg(F.min(d).alias("_d"))
                .filter(F.col("_d") <= F.lit(size)))
        best = cut_lineage(best)                     # small: one row per resolved station
        found = best if found is None else found.unionByName(best)
        todo = cut_lineage(todo.join(best, "station_id", "left_anti"))
        if todo.limit(1).count() == 0:
            break
    res = stations_xy.select("station_id", "x").join(found, "station_id", "left")
    return res.select("station_id", F.when(F.col("x").isNull(), F.lit(None).cast("double"))
                      .when(F.col("_d").isNull(), F.lit(float(none_value)))
                      .otherwise(F.bround(F.col("_d"), 1)).alias(out))


# --- G1 / G2 ------------------------------------------------------------------------

MAX_LEVEL = 16     # 2**16 times the smallest cell is wider than the Earth for discs of 300 m

def edges_xy(edges: DataFrame, lat0: Column, lng0: Column) -> DataFrame:
    x0, y0 = aeqd_xy("lat0", "lon0", lat0, lng0)
    x1, y1 = aeqd_xy("lat1", "lon1", lat0, lng0)
    return edges.withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y1})


def _pieces(edges: DataFrame, size: float) -> DataFrame:
    """Edges cut into pieces no longer than ``size``: sums over pieces equal those over edges.

    A long edge then lists the cells along it, not those of its bounding box."""
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    n = F.greatest(F.lit(1), F.ceil(F.sqrt(dx * dx + dy * dy) / size).cast("int"))
    e = edges.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))

    def at(a, b, k):
        return (F.when(k == 0, F.col(a)).when(k == F.col("_n"), F.col(b))
                .otherwise(F.col(a) + (F.col(b) - F.col(a)) * k / F.col("_n")))

    return e.withColumns({"_x0": at("x0", "x1", F.col("_i") - 1), "_y0": at("y0", "y1", F.col("_i") - 1),
                          "x1": at("x0", "x1", F.col("_i")), "y1": at("y0", "y1", F.col("_i"))}
                         ).withColumns({"x0": F.col("_x0"), "y0": F.col("_y0")}).drop(
        "_x0", "_y0", "_n", "_i")


def _edge_cells(edges: DataFrame, size: float, grow: float) -> DataFrame:
    lo_x = _cell(F.least("x0", "x1") - grow, size)
    hi_x = _cell(F.greatest("x0", "x1") + grow, size)
    lo_y = _cell(F.least("y0", "y1") - grow, size)
    hi_y = _cell(F.greatest("y0", "y1") + grow, size)
    e = edges.withColumn("cx", F.explode(F.sequence(lo_x, hi_x)))
    return e.withColumn("cy", F.explode(F.sequence(lo_y, hi_y)))


def _candidates(stations_xy: DataFrame, edges: DataFrame, radius: float) -> DataFrame:
    size = 2.0 * radius
    e = _edge_cells(_pieces(edges, size), size, radius)
    st = stations_xy.filter(F.col("x").isNotNull()).select(
        "station_id", F.col("x").alias("sx"), F.col("y").alias("sy"),
        _cell(F.col("x"), size).alias("cx"), _cell(F.col("y"), size).alias("cy"))
    c = st.join(e, ["cx", "cy"])
    # coordinates relative to the station (the disc centre)
    return c.withColumns({"ax": F.col("x0") - F.col("sx"), "ay": F.col("y0") - F.col("sy"),
                          "bx": F.col("x1") - F.col("sx"), "by": F.col("y1") - F.col("sy")})


def _polygon_candidates(stations_xy: DataFrame, edges: DataFrame, radius: float,
                        polygon_col: str) -> DataFrame:
    """(station, every edge of each polygon whose box grown by r holds the station).

    The signed-area sum needs *all* edges of a polygon, also those far from the
    station (a disc deep inside a park has no nearby edge at all)."""
    size = 2.0 * radius
    box = edges.groupBy(polygon_col).agg(
        F.least(F.min("x0"), F.min("x1")).alias("x0"), F.greatest(F.max("x0"), F.max("x1")).alias("x1"),
        F.least(F.min("y0"), F.min("y1")).alias("y0"), F.greatest(F.max("y0"), F.max("y1")).alias("y1"))
    # A box uses cells of its own order of size, so it lists at most nine of them however large it
    # is; a station has one cell on each level.
    widest = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) + 2 * radius
    level = F.least(F.lit(MAX_LEVEL), F.greatest(F.lit(0), F.ceil(F.log2(widest / size)).cast("int")))
    side = F.lit(size) * F.pow(F.lit(2.0), F.col("level"))

    def cell(v):
        return F.floor(v / side).cast("int")

    cells = (box.withColumn("level", level)
             .withColumn("cx", F.explode(F.sequence(cell(F.col("x0") - radius), cell(F.col("x1") + radius))))
             .withColumn("cy", F.explode(F.sequence(cell(F.col("y0") - radius), cell(F.col("y1") + radius))))
             .withColumnsRenamed({"x0": "bx0", "x1": "bx1", "y0": "by0", "y1": "by1"}))
    st = stations_xy.filter(F.col("x").isNotNull()).select(
        "station_id", F.col("x").alias("sx"), F.col("y").alias("sy"),
        F.explode(F.sequence(F.lit(0), F.lit(MAX_LEVEL))).alias("level"))
    st = st.withColumns({"cx": cell(F.col("sx")), "cy": cell(F.col("sy"))})
    near = (F.col("sx").between(F.col("bx0") - radius, F.col("bx1") + radius)
            & F.col("sy").between(F.col("by0") - radius, F.col("by1") + radius))
    pairs = st.join(cells, ["level", "cx", "cy"]).filter(near).select(
        "station_id", "sx", "sy", polygon_col)
    c = pairs.join(edges, polygon_col)
    return c.withColumns({"ax": F.col("x0") - F.col("sx"), "ay": F.col("y0") - F.col("sy"),
                          "bx": F.col("x1") - F.col("sx"), "by": F.col("y1") - F.col("sy")})


def _chord_params(r: float):
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    a = dx * dx + dy * dy
    b = 2 * (F.col("ax") * dx + F.col("ay") * dy)
    c = F.col("ax") * F.col("ax") + F.col("ay") * F.col("ay") - F.lit(r * r)
    disc = b * b - 4 * a * c
    sq = F.sqrt(F.greatest(disc, F.lit(0.0)))
    t1 = F.when(a > 0, (-b - sq) / (2 * a))
    t2 = F.when(a > 0, (-b + sq) / (2 * a))
    return a, disc, t1, t2, dx, dy


def line_length_in_radius(stations_xy: DataFrame, edges: DataFrame, radius: float = 500.0,
                          out: str = "bike_lane_length_500m") -> DataFrame:
    """G1: total length of line edges inside the disc of ``radius`` around each station,
    rounded half-even to 0.1 m (0 when none)."""
    c = _candidates(stations_xy, edges, radius)
    a, disc, t1, t2, _, _ = _chord_params(radius)
    lo = F.greatest(t1, F.lit(0.0))
    hi = F.least(t2, F.lit(1.0))
    seg = F.when((a > 0) & (disc > 0), F.greatest(hi - lo, F.lit(0.0)) * F.sqrt(a)).otherwise(F.lit(0.0))
    per = c.groupBy("station_id").agg(F.sum(seg).alias("_len"))
    return (stations_xy.select("station_id", "x").join(per, "station_id", "left")
            .select("station_id", F.when(F.col("x").isNull(), F.lit(None).cast("double"))
                    .otherwise(F.bround(F.coalesce(F.col("_len"), F.lit(0.0)), 1)).alias(out)))


def _sector(ux, uy, vx, vy, r):
    return F.lit(0.5 * r * r) * F.atan2(ux * vy - uy * vx, ux * vx + uy * vy)


def polygon_area_in_radius(stations_xy: DataFrame, edges: DataFrame, radius: float = 500.0,
                           out: str = "park_area_500m", polygon_col: str = "element_id") -> DataFrame:
    """Area of polygons ∩ disc per station; each polygon's directed edges add the
    signed area of triangle(centre, edge) ∩ disc; |sum| per polygon, summed per station."""
    c = _polygon_candidates(stations_xy, edges, radius, polygon_col)
    a, disc, t1, t2, dx, dy = _chord_params(radius)
    hit = (a > 0) & (disc > 0)
    tlo = F.when(hit, F.least(F.greatest(t1, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    thi = F.when(hit, F.least(F.greatest(t2, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    c = c.withColumns({"plx": F.col("ax") + tlo * dx, "ply": F.col("ay") + tlo * dy,
                       "phx": F.col("ax") + thi * dx, "phy": F.col("ay") + thi * dy})
    ax, ay, bx, by = F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")
    plx, ply, phx, phy = F.col("plx"), F.col("ply"), F.col("phx"), F.col("phy")
    signed = (_sector(ax, ay, plx, ply, radius) + F.lit(0.5) * (plx * phy - ply * phx)
              + _sector(phx, phy, bx, by, radius))
    per_poly = c.groupBy("station_id", polygon_col).agg(F.abs(F.sum(signed)).alias("_a"))
    per = per_poly.groupBy("station_id").agg(F.sum("_a").alias("_area"))
    return (stations_xy.select("station_id", "x").join(per, "station_id", "left")
            .select("station_id", F.when(F.col("x").isNull(), F.lit(None).cast("double"))
                    .otherwise(F.bround(F.coalesce(F.col("_area"), F.lit(0.0)), 1)).alias(out)))
