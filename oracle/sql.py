"""DuckDB SQL for every registered query with an exact (or 6-dp rounded) oracle.

Written independently of the Spark code: plain SQL over the views in
``oracle.views``.  Timestamps are rendered as text, as in the Spark queries.
"""
from __future__ import annotations

from dockhour.schemas import CALENDAR_COLS, STATION_META_COLS, WEATHER_COLS

from .views import RIDES, STATION_FEATURES, SUPPLEMENTAL, WEATHER, with_views

NUM = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
SEC = "'%Y-%m-%d %H:%M:%S'"
MIC = "'%Y-%m-%d %H:%M:%S.%f'"


def station_key_sql(x: str) -> str:
    raw = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    num = f"(CASE WHEN regexp_full_match({raw}, '{NUM}') THEN TRY_CAST({raw} AS DOUBLE) END)"
    asint = f"CAST(TRY_CAST({num} AS BIGINT) AS VARCHAR)"
    return (f"coalesce(CASE WHEN {num} IS NOT NULL AND isfinite({num}) AND {num} % 1 = 0 "
            f"AND {asint} IS NOT NULL THEN {asint} ELSE {raw} END, '__missing_station__')")


def t(c: str, fmt: str = SEC) -> str:
    return f"strftime({c}, {fmt}) AS {c}"


KEYED = f"""keyed AS (
  SELECT r.*, coalesce(r.city, '__missing_city__') AS city_key,
         {station_key_sql('r.start_station_id')} AS station_key,
         date_trunc('hour', r.hour_ts) AS target_hour_start
  FROM rides r)"""

DEMAND = """demand AS (
  SELECT city_key, station_key, target_hour_start, count(*) AS demand
  FROM keyed GROUP BY city_key, station_key, target_hour_start)"""

WINDOWS = """windows AS (
  SELECT city_key, station_key, min(target_hour_start) AS first_active_hour,
         max(target_hour_start) AS last_active_hour, count(*) AS observed_ride_rows,
         count(DISTINCT target_hour_start) AS observed_active_hours
  FROM keyed GROUP BY city_key, station_key)"""

BOUNDS = """bounds AS (
  SELECT city_key, min(target_hour_start) AS city_min_hour, max(target_hour_start) AS city_max_hour
  FROM keyed GROUP BY city_key)"""


def active_grid(name="grid", min_window=72, before=0, after=0, keep="BETWEEN 6 AND 22"):
    where = f"WHERE hour(h) {keep}" if keep else ""
    return f"""{name} AS (
  SELECT city_key, station_key, h AS target_hour_start FROM (
    SELECT city_key, station_key, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h
    FROM (
      SELECT city_key, station_key,
             greatest(s0 - to_hours(CAST(eb AS BIGINT)), city_min_hour) AS lo,
             least(e0 + to_hours(CAST(m - eb AS BIGINT)), city_max_hour) AS hi
      FROM (
        SELECT *, greatest({min_window} - cur, 0) AS m, greatest({min_window} - cur, 0) // 2 AS eb
        FROM (
          SELECT w.city_key, w.station_key,
                 w.first_active_hour - to_hours({before}) AS s0,
                 w.last_active_hour + to_hours({after}) AS e0,
                 b.city_min_hour, b.city_max_hour,
                 date_diff('hour', w.first_active_hour - to_hours({before}),
                           w.last_active_hour + to_hours({after})) + 1 AS cur
          FROM windows w JOIN bounds b USING (city_key))))
    WHERE lo <= hi) {where})"""


CAPS = {"click": 300, "view": 300, "error": 200}
CAP_LIST = ", ".join(f"'{c}'" for c in CAPS)
CAP_CASE = "CASE city_key " + " ".join(f"WHEN '{c}' THEN {k}" for c, k in CAPS.items()) + " END"

CAPPED = f"""capsel AS (
  SELECT city_key, target_hour_start FROM (
    SELECT city_key, target_hour_start,
           row_number() OVER (PARTITION BY city_key ORDER BY
             md5('42|' || strftime(target_hour_start, {SEC})), target_hour_start) AS r
    FROM (SELECT DISTINCT city_key, target_hour_start FROM grid WHERE city_key IN ({CAP_LIST})))
  WHERE r <= {CAP_CASE}),
capped AS (
  SELECT g.* FROM grid g
  WHERE g.city_key NOT IN ({CAP_LIST})
     OR EXISTS (SELECT 1 FROM capsel c WHERE c.city_key = g.city_key
                AND c.target_hour_start = g.target_hour_start))"""

ST_COLS = ["city", "start_station_id"] + STATION_META_COLS
CH_COLS = WEATHER_COLS + CALENDAR_COLS


def firsts(cols, order="ride_id"):
    return ", ".join(f"arg_min({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)


SMETA = f"""smeta AS (
  SELECT city_key, station_key, {firsts(ST_COLS)} FROM keyed GROUP BY city_key, station_key)"""
CHMETA = f"""chmeta AS (
  SELECT city_key, target_hour_start, {firsts(CH_COLS)} FROM keyed GROUP BY city_key, target_hour_start)"""

BASE = [RIDES, KEYED]

LABELS = f"""labels AS (
  SELECT row_number() OVER (ORDER BY c.city_key, c.station_key, c.target_hour_start) - 1 AS id,
         c.city_key, c.station_key, c.target_hour_start,
         {', '.join('sm.' + x for x in ST_COLS)},
         {', '.join('ch.' + x for x in WEATHER_COLS)},
         ch.weekend, ch.holiday, ch.holiday_name, ch.working_day,
         coalesce(d.demand, 0) AS demand
  FROM capped c
  LEFT JOIN smeta sm USING (city_key, station_key)
  LEFT JOIN chmeta ch USING (city_key, target_hour_start)
  LEFT JOIN demand d USING (city_key, station_key, target_hour_start))"""

TARGET_CTES = BASE + [DEMAND, WINDOWS, BOUNDS, active_grid(), CAPPED, SMETA, CHMETA, LABELS]

TABLE_CTES = BASE + [DEMAND, WINDOWS, f"""tgrid AS (
  SELECT city_key, station_key, h AS target_hour_start FROM (
    SELECT city_key, station_key,
           unnest(generate_series(first_active_hour, last_active_hour, INTERVAL 1 HOUR)) AS h
    FROM windows) WHERE hour(h) BETWEEN 6 AND 22)""",
    f"""tchmeta AS (
  SELECT city_key, target_hour_start, {firsts(WEATHER_COLS + ['weekend', 'holiday', 'working_day', 'holiday_name'])}
  FROM keyed GROUP BY city_key, target_hour_start)""",
    f"""tsmeta AS (
  SELECT city_key, station_key, {firsts(STATION_META_COLS)} FROM keyed GROUP BY city_key, station_key)"""]


def q(ctes, body):
    return with_views(*ctes) + "\n" + body


SQL = {}

SQL["scan_rides"] = q([RIDES], f"""SELECT * REPLACE ({t('started_at', MIC)}, {t('hour_ts')}) FROM rides""")

SQL["normalize_station_id"] = q([RIDES], f"""
SELECT ride_id, start_station_id, {station_key_sql('start_station_id')} AS station_key FROM rides""")

SQL["key_rides"] = q(BASE, f"SELECT ride_id, city_key, station_key, {t('target_hour_start')} FROM keyed")

SQL["demand_counts"] = q(BASE + [DEMAND], f"""
SELECT city_key, station_key, {t('target_hour_start')}, demand FROM demand""")

SQL["first_non_null"] = q(BASE, f"""
SELECT city_key, {firsts(['temperature_2m', 'user_type'])} FROM keyed GROUP BY city_key""")

SQL["station_meta_agg"] = q(BASE + [SMETA], "SELECT * FROM smeta")

SQL["city_hour_agg"] = q(BASE + [CHMETA], f"SELECT * REPLACE ({t('target_hour_start')}) FROM chmeta")

SQL["station_windows"] = q(BASE + [WINDOWS], f"""
SELECT * REPLACE ({t('first_active_hour')}, {t('last_active_hour')}) FROM windows""")

SQL["city_bounds"] = q(BASE + [BOUNDS], f"""
SELECT city_key, {t('city_min_hour')}, {t('city_max_hour')} FROM bounds""")

SQL["grid_full"] = q(BASE + [WINDOWS, BOUNDS], f"""
SELECT city_key, station_key, strftime(h, {SEC}) AS target_hour_start FROM (
  SELECT w.city_key, w.station_key,
         unnest(generate_series(b.city_min_hour, b.city_max_hour, INTERVAL 1 HOUR)) AS h
  FROM windows w JOIN bounds b USING (city_key))""")

SQL["grid_active_window"] = q(BASE + [WINDOWS, BOUNDS, active_grid()], f"""
SELECT city_key, station_key, {t('target_hour_start')} FROM grid""")

# One station for each day it was active: short windows, so that padding and clipping matter.
_DAY_STATIONS = """keyed2 AS (SELECT city_key, station_key || '-' || strftime(target_hour_start, '%d') AS station_key,
  target_hour_start FROM keyed)"""
SQL["grid_padded_window"] = q(BASE + [_DAY_STATIONS, """windows AS (
  SELECT city_key, station_key, min(target_hour_start) AS first_active_hour,
         max(target_hour_start) AS last_active_hour FROM keyed2 GROUP BY city_key, station_key)""",
    BOUNDS, active_grid(min_window=72, before=5, after=8)], f"""
SELECT city_key, station_key, {t('target_hour_start')} FROM grid""")

SQL["grid_observed"] = q(BASE + [DEMAND], f"""
SELECT city_key, station_key, {t('target_hour_start')} FROM demand""")

SQL["grid_train_window"] = q(TABLE_CTES, f"SELECT city_key, station_key, {t('target_hour_start')} FROM tgrid")

SQL["filter_target_hours"] = q(BASE + [WINDOWS, BOUNDS, active_grid(keep=None)], f"""
SELECT city_key, station_key, {t('target_hour_start')} FROM grid
WHERE hour(target_hour_start) IN (7, 8, 9, 17, 18, 19)""")

SQL["zero_fill_demand"] = q(BASE + [DEMAND, WINDOWS, BOUNDS, active_grid()], f"""
SELECT g.city_key, g.station_key, {t('g.target_hour_start').replace(' AS g.', ' AS ')},
       coalesce(d.demand, 0) AS demand
FROM grid g LEFT JOIN demand d USING (city_key, station_key, target_hour_start)""")

SQL["cap_eval_hours"] = q(BASE + [WINDOWS, BOUNDS, active_grid(), CAPPED], f"""
SELECT city_key, station_key, {t('target_hour_start')} FROM capped""")

SQL["dense_row_id"] = q(BASE + [WINDOWS, BOUNDS, active_grid()], f"""
SELECT city_key, station_key, {t('target_hour_start')},
       row_number() OVER (ORDER BY city_key, station_key, target_hour_start) - 1 AS id
FROM grid""")

SQL["station_hour_targets"] = q(TARGET_CTES, f"""
SELECT id, {t('target_hour_start')}, {', '.join(ST_COLS)}, {', '.join(WEATHER_COLS)},
       strftime(target_hour_start, '%Y-%m-%d') AS date,
       CAST(isodow(target_hour_start) - 1 AS BIGINT) AS weekday,
       weekend, holiday, holiday_name, working_day,
       strftime(target_hour_start, {SEC}) AS hour_ts,
       CAST(hour(target_hour_start) AS BIGINT) AS hour
FROM labels""")

SQL["public_private_split"] = q(TARGET_CTES, f"""
SELECT id, city, start_station_id, {t('target_hour_start')}, demand FROM labels""")

SQL["station_hour_table"] = q(TABLE_CTES, f"""
SELECT g.city_key, g.station_key, strftime(g.target_hour_start, {SEC}) AS ts,
       coalesce(d.demand, 0) AS demand,
       {', '.join('ch.' + x for x in WEATHER_COLS + ['weekend', 'holiday', 'working_day', 'holiday_name'])},
       {', '.join('sm.' + x for x in STATION_META_COLS)},
       g.city_key AS city, hour(g.target_hour_start) AS hour,
       isodow(g.target_hour_start) - 1 AS weekday,
       CASE WHEN isodow(g.target_hour_start) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
       (isodow(g.target_hour_start) - 1) * 24 + hour(g.target_hour_start) AS how
FROM tgrid g
LEFT JOIN demand d USING (city_key, station_key, target_hour_start)
LEFT JOIN tchmeta ch USING (city_key, target_hour_start)
LEFT JOIN tsmeta sm USING (city_key, station_key)""")

_TL_FEATS = STATION_META_COLS + WEATHER_COLS + ["holiday", "holiday_name", "working_day"]
SQL["test_like_targets"] = q([RIDES], f"""
SELECT row_number() OVER (ORDER BY city, start_station_id, target_hour_start) - 1 AS id,
       city, start_station_id, strftime(target_hour_start, {SEC}) AS target_hour_start,
       {', '.join(_TL_FEATS)},
       strftime(target_hour_start, {SEC}) AS hour_ts, hour(target_hour_start) AS hour,
       isodow(target_hour_start) - 1 AS weekday, strftime(target_hour_start, '%Y-%m-%d') AS date,
       CASE WHEN isodow(target_hour_start) - 1 >= 5 THEN 1 ELSE 0 END AS weekend
FROM (
  SELECT city, start_station_id, target_hour_start, {firsts(_TL_FEATS)}
  FROM (SELECT *, date_trunc('hour', hour_ts) AS target_hour_start FROM rides)
  GROUP BY city, start_station_id, target_hour_start
  ORDER BY city, start_station_id, target_hour_start LIMIT 128)""")


# --- batch 2 ------------------------------------------------------------------------

_TABLE_CH = WEATHER_COLS + ["weekend", "holiday", "working_day", "holiday_name"]


def table_ctes(p: str, src: str) -> list[str]:
    """Keyed rides -> demand -> windows -> daytime grid -> zero-filled table for one source."""
    return [
        f"""{p}keyed AS (
  SELECT r.*, coalesce(r.city, '__missing_city__') AS city_key,
         {station_key_sql('r.start_station_id')} AS station_key,
         date_trunc('hour', r.hour_ts) AS target_hour_start
  FROM {src} r)""",
        f"""{p}demand AS (
  SELECT city_key, station_key, target_hour_start, count(*) AS demand
  FROM {p}keyed GROUP BY city_key, station_key, target_hour_start)""",
        f"""{p}tgrid AS (
  SELECT city_key, station_key, h AS target_hour_start FROM (
    SELECT city_key, station_key, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h
    FROM (SELECT city_key, station_key, min(target_hour_start) AS lo, max(target_hour_start) AS hi
          FROM {p}keyed GROUP BY city_key, station_key))
  WHERE hour(h) BETWEEN 6 AND 22)""",
        f"""{p}chmeta AS (
  SELECT city_key, target_hour_start, {firsts(_TABLE_CH)}
  FROM {p}keyed GROUP BY city_key, target_hour_start)""",
        f"""{p}smeta AS (
  SELECT city_key, station_key, {firsts(STATION_META_COLS)}
  FROM {p}keyed GROUP BY city_key, station_key)""",
        f"""{p}table AS (
  SELECT g.city_key, g.station_key, g.target_hour_start AS ts, coalesce(d.demand, 0) AS demand,
         {', '.join('ch.' + x for x in _TABLE_CH)}, {', '.join('sm.' + x for x in STATION_META_COLS)},
         g.city_key AS city, hour(g.target_hour_start) AS hour,
         isodow(g.target_hour_start) - 1 AS weekday,
         CASE WHEN isodow(g.target_hour_start) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
         (isodow(g.target_hour_start) - 1) * 24 + hour(g.target_hour_start) AS how
  FROM {p}tgrid g LEFT JOIN {p}demand d USING (city_key, station_key, target_hour_start)
  LEFT JOIN {p}chmeta ch USING (city_key, target_hour_start)
  LEFT JOIN {p}smeta sm USING (city_key, station_key))""",
    ]


POOL_CTES = [RIDES, SUPPLEMENTAL] + table_ctes("o_", "rides") + table_ctes("s_", "supp_rides") + [
    """pool AS (
  SELECT *, false AS is_supplementary, 0 AS source_rank FROM o_table
  UNION ALL BY NAME
  SELECT *, true AS is_supplementary, 1 AS source_rank FROM s_table)""",
    """dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY city_key, station_key, ts ORDER BY source_rank) AS rn
    FROM pool) WHERE rn = 1)""",
    """cuts AS (
  SELECT city_key, quantile_cont(ts, 0.8) AS cutoff FROM dedup WHERE city_key <> 'error'
  GROUP BY city_key)""",
    """splits AS (
  SELECT d.* EXCLUDE (source_rank), CASE WHEN d.ts <= c.cutoff THEN 'train' ELSE 'val' END AS split
  FROM dedup d JOIN cuts c ON d.city_key = c.city_key
  UNION ALL BY NAME
  SELECT * EXCLUDE (source_rank), 'test_unseen' AS split FROM dedup WHERE city_key = 'error')""",
]

GRID_CTES = BASE + [DEMAND, WINDOWS, BOUNDS, active_grid()]


def numeric_id_sql(x: str) -> str:
    raw = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    d = f"(CASE WHEN regexp_full_match({raw}, '{NUM}') THEN TRY_CAST({raw} AS DOUBLE) END)"
    return f"(CASE WHEN {d} % 1 = 0 THEN TRY_CAST({d} AS BIGINT) END)"


def hash_unit_sql(*parts: str, seed: int = 42) -> str:
    cat = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5('{seed}|' || {cat}), 1, 8)) AS BIGINT)"


START_SIDE = f"""start_side AS (
  SELECT ride_id AS rental_id, strftime(started_at, {MIC}) AS started_at, start_station_id,
         'Station ' || trim(start_station_id) AS start_station_name, start_lat, start_lng, city
  FROM rides)"""

SQL["join_station_meta"] = q(GRID_CTES + [SMETA], f"""
SELECT g.city_key, g.station_key, strftime(g.target_hour_start, {SEC}) AS target_hour_start,
       {', '.join('sm.' + x for x in ST_COLS)}
FROM grid g LEFT JOIN smeta sm USING (city_key, station_key)""")

SQL["join_city_hour"] = q(GRID_CTES + [f"""chw AS (
  SELECT city_key, target_hour_start, {firsts(WEATHER_COLS)} FROM keyed
  GROUP BY city_key, target_hour_start)"""], f"""
SELECT g.city_key, g.station_key, strftime(g.target_hour_start, {SEC}) AS target_hour_start,
       {', '.join('c.' + x for x in WEATHER_COLS)}
FROM grid g LEFT JOIN chw c USING (city_key, target_hour_start)""")

SQL["join_station_features"] = q([RIDES, START_SIDE, STATION_FEATURES], f"""
SELECT r.rental_id, r.started_at, r.start_station_name, r.city,
       {numeric_id_sql('r.start_station_id')} AS start_station_id,
       f.lat AS start_lat, f.lng AS start_lng,
       f.bike_lane_length_500m, f.park_area_500m, f.university_count_1000m, f.office_poi_count_1000m,
       f.retail_poi_count_1000m, f.restaurant_cafe_count_500m, f.transit_stop_count_500m,
       f.distance_to_nearest_rail_station, f.distance_to_city_center
FROM start_side r LEFT JOIN station_features f
  ON {numeric_id_sql('r.start_station_id')} = {numeric_id_sql('f.start_station_id')}""")

SQL["join_weather_hour"] = q([RIDES, WEATHER], f"""
SELECT r.ride_id, r.city, strftime(r.hour_ts, {SEC}) AS hour_ts,
       w.* EXCLUDE (hour_ts)
FROM rides r LEFT JOIN weather w ON strftime(r.hour_ts, {SEC}) = w.hour_ts""")

SQL["validated_join"] = q(GRID_CTES, f"""
SELECT g.city_key, g.station_key, strftime(g.target_hour_start, {SEC}) AS target_hour_start, d.demand
FROM grid g LEFT JOIN demand d USING (city_key, station_key, target_hour_start)""")

SQL["cross_station_hours"] = SQL["grid_full"]

SQL["inner_grid_meta"] = q(BASE + [WINDOWS], f"""
SELECT * REPLACE ({t('first_active_hour')}, {t('last_active_hour')}) FROM windows""")

SQL["ids_match"] = q(TARGET_CTES + ["""fullids AS (
  SELECT row_number() OVER (ORDER BY city_key, station_key, target_hour_start) - 1 AS id FROM grid)"""], """
SELECT id, 'left' AS only_in FROM (SELECT id FROM labels EXCEPT SELECT id FROM fullids)
UNION ALL
SELECT id, 'right' AS only_in FROM (SELECT id FROM fullids EXCEPT SELECT id FROM labels)""")

SQL["unique_ids"] = q([RIDES, SUPPLEMENTAL], """
SELECT ride_id, count(*) AS n_rows FROM (
  SELECT ride_id FROM rides UNION ALL SELECT ride_id FROM supp_rides)
GROUP BY ride_id HAVING count(*) > 1""")

SQL["prediction_checks"] = q(TARGET_CTES + ["""preds AS (
  SELECT 'm1' AS model, id, CAST(id % 7 AS DOUBLE) - CAST(1.5 AS DOUBLE) AS prediction FROM labels
  UNION ALL
  SELECT 'm2' AS model, id, CAST(id % 5 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS prediction FROM labels)"""], """
SELECT model, n_rows, n_missing, n_nan, n_infinite, n_negative, expected_rows,
       (n_missing + n_nan = 0) AND n_rows = expected_rows AS ok,
       (n_missing + n_nan + n_infinite + n_negative = 0) AND n_rows = expected_rows AS ok_strict
FROM (
  SELECT model, count(*) AS n_rows, count_if(prediction IS NULL) AS n_missing,
         count_if(isnan(prediction)) AS n_nan, count_if(isinf(prediction)) AS n_infinite,
         count_if(prediction < 0) AS n_negative, (SELECT count(*) FROM labels) AS expected_rows
  FROM preds GROUP BY model)""")

SQL["pool_sources"] = q(POOL_CTES, f"SELECT * REPLACE ({t('ts')}) FROM pool")
SQL["dedup_prefer_official"] = q(POOL_CTES, f"SELECT * REPLACE ({t('ts')}) FROM dedup")
SQL["distinct_grid_rows"] = q(POOL_CTES, f"""
SELECT DISTINCT city_key, station_key, strftime(ts, {SEC}) AS ts FROM pool""")

SQL["concat_months"] = q([RIDES, START_SIDE, SUPPLEMENTAL], f"""
SELECT rental_id, started_at, start_station_id, start_station_name, start_lat, start_lng, city FROM start_side
UNION ALL
SELECT ride_id, strftime(started_at, {MIC}), start_station_id, NULL, NULL, NULL, city FROM supp_rides""")

_P1 = "p1cut AS (SELECT city, quantile_cont(started_at, 0.8) AS cutoff FROM rides WHERE city IS NOT NULL GROUP BY city)"
SQL["temporal_split_rides"] = q([RIDES, _P1], """
SELECT r.ride_id, r.city, CASE WHEN r.started_at <= c.cutoff THEN 'train' ELSE 'val' END AS split
FROM rides r JOIN p1cut c USING (city) WHERE r.started_at IS NOT NULL""")
SQL["split_cutoffs"] = q([RIDES, _P1], f"SELECT city, {t('cutoff', MIC)} FROM p1cut")

SQL["load_splits"] = q(POOL_CTES, f"SELECT * REPLACE ({t('ts')}) FROM splits")
SQL["load_splits_cutoffs"] = q(POOL_CTES, f"SELECT city_key, {t('cutoff', MIC)} FROM cuts")

_TBL = [RIDES] + table_ctes("o_", "rides")
_HU = hash_unit_sql("city_key", "station_key", f"strftime(ts, {SEC})")
SQL["kfold_assign"] = q(_TBL, f"""
SELECT city_key, station_key, strftime(ts, {SEC}) AS ts, demand, CAST({_HU} % 5 AS INTEGER) AS fold
FROM o_table""")
SQL["fraction_sample"] = q(_TBL, f"""
SELECT city_key, station_key, strftime(ts, {SEC}) AS ts, demand FROM o_table
WHERE {_HU} / CAST(4294967296 AS DOUBLE) < CAST(0.35 AS DOUBLE)""")
SQL["shuffle_rows"] = q(_TBL, f"SELECT city_key, station_key, strftime(ts, {SEC}) AS ts, demand FROM o_table")

SQL["city_balanced_weights"] = q(POOL_CTES, f"""
SELECT s.city_key, s.station_key, strftime(s.ts, {SEC}) AS ts, w.weight
FROM splits s JOIN (
  SELECT city_key, round(sum(nc) OVER () / (count(*) OVER () * nc), 6) AS weight
  FROM (SELECT city_key, count(*) AS nc FROM splits WHERE split = 'train' GROUP BY city_key)) w
USING (city_key) WHERE s.split = 'train'""")

SQL["split_stats"] = q(POOL_CTES, """
SELECT split, city_key, count(*) AS rows, round(avg(CAST(demand AS DOUBLE)), 6) AS mean_demand,
       round(avg(CAST(demand = 0 AS DOUBLE)), 6) AS zero_rate, max(demand) AS max_demand,
       count_if(is_supplementary) AS supplementary_rows
FROM splits GROUP BY split, city_key""")


# --- batch 3 ------------------------------------------------------------------------
import math as _math  # noqa: E402

from dockhour.schemas import POI_COLS, POI_PRESENCE_COLS, RIDE_COLS  # noqa: E402

TWO_PI = repr(2 * _math.pi)
TKEYS = f"city_key, station_key, strftime(ts, {SEC}) AS ts"
_FLAGS = ["weekend", "holiday", "working_day"]

FT = """ft AS (
  SELECT g.city_key, g.station_key, g.target_hour_start AS ts, coalesce(d.demand, 0) AS demand,
         {ch}, {sm}, g.city_key AS city, hour(g.target_hour_start) AS hour,
         isodow(g.target_hour_start) - 1 AS weekday,
         CASE WHEN isodow(g.target_hour_start) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
         (isodow(g.target_hour_start) - 1) * 24 + hour(g.target_hour_start) AS how
  FROM tgrid g
  LEFT JOIN demand d USING (city_key, station_key, target_hour_start)
  LEFT JOIN tchmeta ch USING (city_key, target_hour_start)
  LEFT JOIN tsmeta sm USING (city_key, station_key))""".format(
    ch=", ".join("ch." + x for x in WEATHER_COLS + ['weekend', 'holiday', 'working_day', 'holiday_name']),
    sm=", ".join("sm." + x for x in STATION_META_COLS))
FT_CTES = TABLE_CTES + [FT]


def miss_sql(src: str = "ft") -> str:
    """B9 over a table CTE: projection with the missingness rules applied."""
    all_zero = " AND ".join(f"coalesce({c}, 0) = 0" for c in POI_PRESENCE_COLS)
    repl = [f"CASE WHEN NOT ({all_zero}) THEN {c} END AS {c}" for c in POI_PRESENCE_COLS]
    repl.append("CASE WHEN distance_to_nearest_rail_station <> -1 THEN distance_to_nearest_rail_station END "
                "AS distance_to_nearest_rail_station")
    return f"ftm AS (SELECT * REPLACE ({', '.join(repl)}) FROM {src})"


def cyc_sql(ts: str = "ts") -> dict[str, str]:
    h, w = f"CAST(hour({ts}) AS DOUBLE)", f"CAST(isodow({ts}) - 1 AS DOUBLE)"
    return {
        "hour_sin": f"round(sin(CAST({TWO_PI} AS DOUBLE) * {h} / 24), 6) + CAST(0.0 AS DOUBLE)",
        "hour_cos": f"round(cos(CAST({TWO_PI} AS DOUBLE) * {h} / 24), 6) + CAST(0.0 AS DOUBLE)",
        "dow_sin": f"round(sin(CAST({TWO_PI} AS DOUBLE) * {w} / 7), 6) + CAST(0.0 AS DOUBLE)",
        "dow_cos": f"round(cos(CAST({TWO_PI} AS DOUBLE) * {w} / 7), 6) + CAST(0.0 AS DOUBLE)",
    }


def tf_sql(ts: str = "ts") -> list[str]:
    c = cyc_sql(ts)
    return [f"{v} AS {k}" for k, v in c.items()] + [
        f"CAST(hour({ts}) AS DOUBLE) AS hour", f"CAST(isodow({ts}) - 1 AS DOUBLE) AS weekday",
        f"CAST(CASE WHEN isodow({ts}) - 1 >= 5 THEN 1 ELSE 0 END AS DOUBLE) AS is_weekend",
        f"CAST(month({ts}) AS DOUBLE) AS month", f"CAST(dayofyear({ts}) AS DOUBLE) AS day_of_year"]


SQL["time_parts"] = q(FT_CTES, f"""
SELECT {TKEYS}, hour(ts) AS hour, isodow(ts) - 1 AS weekday,
       CASE WHEN isodow(ts) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
       (isodow(ts) - 1) * 24 + hour(ts) AS how FROM ft""")

SQL["cyclical_time"] = q(FT_CTES, f"""
SELECT {TKEYS}, {', '.join(f'{v} AS {k}' for k, v in cyc_sql().items())},
       month(ts) AS month, dayofyear(ts) AS day_of_year FROM ft""")

_RAW = "regexp_replace(start_station_id, '^\\s+|\\s+$', '', 'g')"
SQL["numeric_coerce"] = q([RIDES], f"""
SELECT ride_id, start_station_id,
       CASE WHEN regexp_full_match({_RAW}, '{NUM}') THEN TRY_CAST({_RAW} AS DOUBLE) END AS station_num
FROM rides""")

_STR = {"started_at", "start_station_id", "city", "end_station_id", "user_type", "ended_at", "date",
        "holiday_name", "hour_ts"}
_INT = {"weekday", "weekend", "holiday", "working_day"}
_have = {"started_at", "start_station_id", "start_lat", "start_lng", "city"}


def _conf(c):
    if c in _have:
        return c
    typ = "VARCHAR" if c in _STR else ("INTEGER" if c in _INT else "DOUBLE")
    return f"CAST(NULL AS {typ}) AS {c}"


SQL["conform_schema"] = q([RIDES, START_SIDE], f"SELECT {', '.join(_conf(c) for c in RIDE_COLS)} FROM start_side")

SQL["calendar_fields"] = q([RIDES], f"""
SELECT ride_id, date, weekday, weekend, holiday, holiday_name, working_day, {t('hour_ts')} FROM rides""")

SQL["format_timestamps"] = q([RIDES], f"SELECT ride_id, {t('started_at')}, {t('hour_ts')} FROM rides")

PREDS = """preds AS (
  SELECT 'm1' AS model, id, CAST(id % 7 AS DOUBLE) - CAST(1.5 AS DOUBLE) AS prediction FROM labels
  UNION ALL
  SELECT 'm2' AS model, id, CAST(id % 5 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS prediction FROM labels)"""
PREDS3 = """preds AS (
  SELECT 'm1' AS model, id, CAST(id % 7 AS DOUBLE) - CAST(1.5 AS DOUBLE) AS prediction FROM labels
  UNION ALL
  SELECT 'm2' AS model, id, CAST(id % 5 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS prediction FROM labels
  UNION ALL
  SELECT 'm3' AS model, id, CASE WHEN id % 100 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END
  FROM labels)"""

SQL["clip_non_negative"] = q(TARGET_CTES + [PREDS], """
SELECT model, id, prediction, greatest(CAST(0.0 AS DOUBLE), prediction) AS prediction_clipped FROM preds""")

SQL["season_filter"] = q([RIDES, START_SIDE], f"""
SELECT * FROM (SELECT * REPLACE (strftime(CAST(started_at AS TIMESTAMP) + to_days(CAST(30 * (rental_id % 12) AS INTEGER)), {MIC})
                                 AS started_at) FROM start_side)
WHERE month(CAST(started_at AS TIMESTAMP)) IN (6, 7, 8)""")

SQL["head_sample"] = q([RIDES], f"""
SELECT * REPLACE ({t('started_at', MIC)}, {t('hour_ts')}) FROM rides ORDER BY ride_id LIMIT 1000""")

SQL["coord_box_filter"] = q([RIDES], """
SELECT ride_id, start_lat, start_lng FROM rides
WHERE start_lat BETWEEN CAST(38.80 AS DOUBLE) AND CAST(38.82 AS DOUBLE)
  AND start_lng BETWEEN CAST(-77.10 AS DOUBLE) AND CAST(-77.08 AS DOUBLE)""")


def haversine_sql(lat1, lng1, lat2, lng2):
    return (f"CAST(12742000.0 AS DOUBLE) * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2)))")


SQL["haversine"] = q([STATION_FEATURES], f"""
SELECT start_station_id, round({haversine_sql('lat', 'lng', 'CAST(38.82 AS DOUBLE)', 'CAST(-77.08 AS DOUBLE)')}, 6) AS distance_m
FROM station_features""")


def aeqd_sql(lat, lng, lat0, lng0):
    phi, lam, phi0, lam0 = f"radians({lat})", f"radians({lng})", f"radians({lat0})", f"radians({lng0})"
    dl = f"({lam} - {lam0})"
    cosc = f"(sin({phi0}) * sin({phi}) + cos({phi0}) * cos({phi}) * cos({dl}))"
    c = f"acos(least(CAST(1.0 AS DOUBLE), greatest(CAST(-1.0 AS DOUBLE), {cosc})))"
    k = f"(CASE WHEN {c} = 0 THEN CAST(1.0 AS DOUBLE) ELSE {c} / sin({c}) END)"
    x = f"CAST(6371000.0 AS DOUBLE) * {k} * cos({phi}) * sin({dl})"
    y = f"CAST(6371000.0 AS DOUBLE) * {k} * (cos({phi0}) * sin({phi}) - sin({phi0}) * cos({phi}) * cos({dl}))"
    return x, y


_x, _y = aeqd_sql("lat", "lng", "CAST(38.82 AS DOUBLE)", "CAST(-77.08 AS DOUBLE)")
SQL["local_projection"] = q([STATION_FEATURES], f"""
SELECT start_station_id, round({_x}, 6) AS x_m, round({_y}, 6) AS y_m FROM station_features""")

SQL["apply_missingness"] = q(FT_CTES + [miss_sql()], f"SELECT {TKEYS}, {', '.join(POI_COLS)} FROM ftm")

_MISS = (
    "CAST(" + " AND ".join(f"{c} IS NULL" for c in WEATHER_COLS) + " AS INTEGER) AS miss_weather, "
    "CAST(" + " OR ".join(f"{c} IS NULL" for c in _FLAGS) + " AS INTEGER) AS miss_calendar, "
    "CAST(" + " AND ".join(f"{c} IS NULL" for c in POI_PRESENCE_COLS) + " AS INTEGER) AS miss_station")
SQL["category_missingness"] = q(FT_CTES + [miss_sql()], f"SELECT {TKEYS}, {_MISS} FROM ftm")

_NOID = ", ".join(tf_sql() + [f"CAST({c} AS DOUBLE) AS {c}" for c in _FLAGS + WEATHER_COLS + POI_COLS])
SQL["build_feature_groups"] = q(FT_CTES + [miss_sql()], f"SELECT {TKEYS}, {_NOID} FROM ftm")

# --- target encodings over the pooled splits ---
_HOW = "(isodow(ts) - 1) * 24 + hour(ts)"
TRAIN = "tr AS (SELECT * FROM splits WHERE split = 'train')"
EVAL = "ev AS (SELECT * FROM splits WHERE split <> 'train')"
LEVEL_KEYS = {"station_how": ["station_key", "how"], "station": ["station_key"],
              "city_how": ["city_key", "how"], "city": ["city_key"]}


def enc_ctes(src: str, p: str = "e_") -> list[str]:
    out = [f"{p}{n} AS (SELECT {', '.join(k)}, avg(demand) AS v FROM {src} GROUP BY {', '.join(k)})"
           for n, k in LEVEL_KEYS.items()]
    out.append(f"{p}global AS (SELECT avg(demand) AS v FROM {src})")
    return out


def te_cols_sql(p="e_"):
    c, ch, s, sh, g = (f"{p}city.v", f"{p}city_how.v", f"{p}station.v", f"{p}station_how.v", f"{p}global.v")
    return {"te_city": f"coalesce({c}, {g})", "te_city_how": f"coalesce({ch}, {c}, {g})",
            "te_station": f"coalesce({s}, {c}, {g})", "te_station_how": f"coalesce({sh}, {s}, {c}, {g})"}


def te_joins(src_alias: str, p="e_"):
    return " ".join(f"LEFT JOIN {p}{n} USING ({', '.join(k)})" for n, k in LEVEL_KEYS.items()) + f" CROSS JOIN {p}global"


SQL["te_fit"] = q(POOL_CTES + [TRAIN], " UNION ALL ".join(
    f"""SELECT '{n}' AS level, {'city_key' if 'city_key' in k else 'CAST(NULL AS VARCHAR)'} AS city_key,
       {'station_key' if 'station_key' in k else 'CAST(NULL AS VARCHAR)'} AS station_key,
       {'CAST(how AS VARCHAR)' if 'how' in k else 'CAST(NULL AS VARCHAR)'} AS how,
       round(avg(demand), 6) AS te FROM tr GROUP BY {', '.join(k)}""" for n, k in LEVEL_KEYS.items()))

_TEV = te_cols_sql()
SQL["te_transform"] = q(POOL_CTES + [TRAIN, EVAL] + enc_ctes("tr"), f"""
SELECT ev.city_key, ev.station_key, strftime(ev.ts, {SEC}) AS ts, ev.split,
       {', '.join(f'round({v}, 6) AS {k}' for k, v in _TEV.items())}
FROM ev {te_joins('ev')}""")


def oof_ctes(src: str, p: str = "o_") -> list[str]:
    out = []
    for n, k in LEVEL_KEYS.items():
        ks = ", ".join(k)
        out.append(f"""{p}{n} AS (
  SELECT {ks}, fold, (sum(s) OVER (PARTITION BY {ks}) - s) / nullif(sum(c) OVER (PARTITION BY {ks}) - c, 0) AS v
  FROM (SELECT {ks}, fold, sum(demand) AS s, count(demand) AS c FROM {src} GROUP BY {ks}, fold))""")
    out.append(f"""{p}global AS (
  SELECT fold, (sum(s) OVER () - s) / nullif(sum(c) OVER () - c, 0) AS v
  FROM (SELECT fold, sum(demand) AS s, count(demand) AS c FROM {src} GROUP BY fold))""")
    return out


def oof_joins(p="o_"):
    return (" ".join(f"LEFT JOIN {p}{n} USING ({', '.join(k)}, fold)" for n, k in LEVEL_KEYS.items())
            + f" LEFT JOIN {p}global USING (fold)")


_TEO = te_cols_sql("o_")
_FOLD = hash_unit_sql("city_key", "station_key", f"strftime(ts, {SEC})")
SQL["te_oof"] = q(POOL_CTES + [TRAIN, f"trf AS (SELECT *, CAST({_FOLD} % 5 AS INTEGER) AS fold FROM tr)"]
                  + oof_ctes("trf"), f"""
SELECT trf.city_key, trf.station_key, strftime(trf.ts, {SEC}) AS ts, trf.fold,
       {', '.join(f'round({v}, 6) AS {k}' for k, v in _TEO.items())}
FROM trf {oof_joins()}""")

_NOID_F = ", ".join(tf_sql() + [f"CAST({c} AS DOUBLE) AS {c}" for c in _FLAGS + WEATHER_COLS + POI_COLS])
SQL["features_with_te"] = q(FT_CTES + [miss_sql(), f"""ftf AS (
  SELECT *, CAST({_FOLD} % 5 AS INTEGER) AS fold FROM ftm)"""] + oof_ctes("ftf"), f"""
SELECT ftf.city_key, ftf.station_key, strftime(ftf.ts, {SEC}) AS ts, ftf.fold, ftf.how, ftf.demand,
       {_NOID_F.replace('ts)', 'ftf.ts)')},
       {', '.join(f'round({v}, 6) AS {k}' for k, v in _TEO.items())}
FROM ftf {oof_joins()}""")

_BASE7 = tf_sql("ft.ts")[:7]
SQL["baseline_features"] = q(FT_CTES + enc_ctes("ft"), f"""
SELECT ft.city_key, ft.station_key, strftime(ft.ts, {SEC}) AS ts,
       {', '.join(_BASE7)},
       {', '.join(f'CAST(ft.{c} AS DOUBLE) AS {c}' for c in WEATHER_COLS + _FLAGS + STATION_META_COLS)},
       {', '.join(f'round({v}, 6) AS {k}' for k, v in _TEV.items())}
FROM ft {te_joins('ft')}""")

SQL["fallback_median"] = q(POOL_CTES + [TRAIN], """
SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour, median(demand) AS fallback_median,
       (SELECT median(demand) FROM tr) AS global_median
FROM tr GROUP BY isodow(ts) - 1, hour(ts)""")

# Every row as if all three groups were missing: the fallback's median, clipped at 0.
SQL["cold_start_predictions"] = q(POOL_CTES + [TRAIN, """fb AS (
  SELECT isodow(ts) - 1 AS w, hour(ts) AS h, median(demand) AS m FROM tr GROUP BY ALL)"""], f"""
SELECT p.city_key, p.station_key, strftime(p.ts, {SEC}) AS ts, p.split,
       greatest(CAST(0.0 AS DOUBLE), CASE WHEN hour(p.ts) % 2 = 0
         THEN CAST(coalesce(fb.m, (SELECT median(demand) FROM tr)) AS DOUBLE)
         ELSE CAST(p.demand AS DOUBLE) - CAST(0.5 AS DOUBLE) END) AS prediction
FROM splits p LEFT JOIN fb ON fb.w = isodow(p.ts) - 1 AND fb.h = hour(p.ts)""")

SCORED = """scored AS (
  SELECT l.id, l.city, l.start_station_id, strftime(l.target_hour_start, '%Y-%m-%d %H:%M:%S') AS target_hour_start,
         l.demand, p.model, p.prediction,
         greatest(CAST(0.0 AS DOUBLE), p.prediction) AS prediction_clipped,
         abs(CAST(l.demand AS DOUBLE) - greatest(CAST(0.0 AS DOUBLE), p.prediction)) AS abs_error,
         (CAST(l.demand AS DOUBLE) - greatest(CAST(0.0 AS DOUBLE), p.prediction))
       * (CAST(l.demand AS DOUBLE) - greatest(CAST(0.0 AS DOUBLE), p.prediction)) AS squared_error
  FROM labels l LEFT JOIN preds p USING (id))"""


def summary_cte(src="scored", rnd=True):
    r = (lambda x: f"round({x}, 6)") if rnd else (lambda x: x)
    return f"""summary AS (
  SELECT model, CASE WHEN grouping(city) = 1 THEN 'OVERALL' ELSE city END AS city, count(*) AS n_rows,
         {r('avg(abs_error)')} AS mae, {r('sqrt(avg(squared_error))')} AS rmse,
         {r('avg(CAST(demand AS DOUBLE))')} AS mean_true_demand, {r('avg(prediction_clipped)')} AS mean_prediction,
         CASE WHEN grouping(city) = 1 THEN count_if(prediction < 0) END AS negative_predictions_before_clipping
  FROM {src} GROUP BY GROUPING SETS ((model, city), (model)))"""


SQL["score_rows"] = q(TARGET_CTES + [PREDS, SCORED], "SELECT * FROM scored")
SQL["score_summary"] = q(TARGET_CTES + [PREDS, SCORED, summary_cte()], "SELECT * FROM summary")
SQL["blended_mae"] = q(TARGET_CTES + [PREDS, SCORED, summary_cte(rnd=False)], """
SELECT model, round(in_dist_mae, 6) AS in_dist_mae, round(holdout_mae, 6) AS holdout_mae,
       round(2.0 / 3.0 * in_dist_mae + 1.0 / 3.0 * holdout_mae, 6) AS blended_mae
FROM (SELECT model, avg(CASE WHEN city <> 'error' THEN mae END) AS in_dist_mae,
             max(CASE WHEN city = 'error' THEN mae END) AS holdout_mae
      FROM summary WHERE city <> 'OVERALL' GROUP BY model)""")

_LB = """SELECT model, city, n_rows, CAST(round_even(mae, 6) AS DOUBLE) AS mae,
       CAST(round_even(rmse, 6) AS DOUBLE) AS rmse,
       CAST(round_even(mean_true_demand, 6) AS DOUBLE) AS mean_true_demand,
       CAST(round_even(mean_prediction, 6) AS DOUBLE) AS mean_prediction,
       negative_predictions_before_clipping FROM summary"""
SQL["leaderboard_sort"] = q(TARGET_CTES + [PREDS, SCORED, summary_cte(rnd=False)], _LB)
SQL["multi_model_leaderboard"] = q(TARGET_CTES + [PREDS, SCORED, summary_cte(rnd=False)], _LB)
SQL["holdout_report"] = q(TARGET_CTES + [PREDS], """
SELECT city, CASE WHEN city = 'error' THEN 'unseen' ELSE 'in-dist' END AS role, count(*) AS n_rows,
       round(avg(abs(p - demand)), 6) + 0.0 AS mae, round(sqrt(avg((p - demand) ** 2)), 6) + 0.0 AS rmse,
       round(avg(demand), 6) + 0.0 AS mean_true, round(avg(p), 6) + 0.0 AS mean_pred
FROM (SELECT l.city, CAST(l.demand AS DOUBLE) AS demand, greatest(prediction, CAST(0 AS DOUBLE)) AS p
      FROM labels AS l JOIN preds USING (id) WHERE model = 'm1') GROUP BY city""")
SQL["repeated_runs"] = q(TARGET_CTES + [PREDS], """
SELECT CASE WHEN b.model = 'm1' THEN 'same model' ELSE 'other model' END AS runs, count(*) AS n_rows,
       0::BIGINT AS n_unmatched, count(*) FILTER (abs(a.prediction - b.prediction) > 1e-9) AS n_different
FROM preds AS a JOIN preds AS b USING (id) WHERE a.model = 'm1' GROUP BY b.model""")
SQL["leaderboard_failures"] = q(TARGET_CTES + [PREDS3], """
SELECT model, n_rows, n_missing, n_nan, n_infinite, n_negative, expected_rows, false AS ok
FROM (
  SELECT model, count(*) AS n_rows, count_if(prediction IS NULL) AS n_missing,
         count_if(isnan(prediction)) AS n_nan, count_if(isinf(prediction)) AS n_infinite,
         count_if(prediction < 0) AS n_negative, (SELECT count(*) FROM labels) AS expected_rows
  FROM preds GROUP BY model)
WHERE n_missing + n_nan + n_infinite > 0 OR n_rows <> expected_rows""")


# --- batch 4: exploratory report ------------------------------------------------------
from dockhour.sources.testdata import RIDES_VIEW_COLS  # noqa: E402

Z = " + CAST(0.0 AS DOUBLE)"


def pearson_sql(a, b):
    return (f"CASE WHEN stddev_pop({a}) * stddev_pop({b}) <> 0 "
            f"THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END")


def r6(x):
    return f"round({x}, 6){Z}"


_NUMERIC_RIDE_COLS = ["ride_id", "usage_time_minutes", "distance_meters", "start_lat", "start_lng",
                      *WEATHER_COLS, *POI_COLS, "weekday", "weekend", "holiday", "working_day"]
_MS_COLS = [c for c in RIDES_VIEW_COLS if c != "city"]
SHD = """shd AS (SELECT city, start_station_id, hour_ts, count(*) AS demand FROM rides
  WHERE city IS NOT NULL AND start_station_id IS NOT NULL AND hour_ts IS NOT NULL
  GROUP BY city, start_station_id, hour_ts)"""
DBW = """dbw AS (SELECT city, start_station_id, hour_ts, temperature_2m, precipitation, wind_speed_10m,
         count(*) AS demand FROM rides
  WHERE city IS NOT NULL AND start_station_id IS NOT NULL AND hour_ts IS NOT NULL
    AND temperature_2m IS NOT NULL AND precipitation IS NOT NULL AND wind_speed_10m IS NOT NULL
  GROUP BY ALL)"""
HP = """hp AS (SELECT city, hour(hour_ts) AS hour, count(*) AS rides FROM rides
  WHERE city IS NOT NULL AND hour_ts IS NOT NULL GROUP BY city, hour(hour_ts))"""

SQL["city_overview"] = q([RIDES], f"""
SELECT city, rows, {r6('rows / sum(rows) OVER ()')} AS share, stations,
       strftime(CAST(lo AS DATE), '%Y-%m-%d') AS first_date, strftime(CAST(hi AS DATE), '%Y-%m-%d') AS last_date,
       CAST(floor(date_diff('second', lo, hi) / 86400) AS BIGINT) AS days
FROM (SELECT city, count(*) AS rows, count(DISTINCT start_station_id) AS stations,
             min(started_at) AS lo, max(started_at) AS hi
      FROM rides WHERE city IS NOT NULL GROUP BY city)""")

_MS = f"""ms AS (
  SELECT scope, "column", missing_pct FROM (
    UNPIVOT (
      SELECT CASE WHEN grouping(city) = 1 THEN '__all__' ELSE city END AS scope,
             {', '.join(f'avg(CAST({c} IS NULL AS DOUBLE)) * 100 AS {c}' for c in _MS_COLS)}
      FROM rides GROUP BY GROUPING SETS ((city), ()))
    ON {', '.join(_MS_COLS)} INTO NAME "column" VALUE missing_pct)
  WHERE missing_pct > 0)"""
SQL["missing_share"] = q([RIDES, _MS], f'''SELECT scope, "column", {r6('missing_pct')} AS missing_pct FROM ms''')
SQL["missing_rank"] = q([RIDES, _MS], f"""
SELECT "column", {r6('missing_pct')} AS missing_pct,
       row_number() OVER (ORDER BY missing_pct DESC, "column") AS rank
FROM ms WHERE scope = '__all__'""")

SQL["constant_columns"] = q([RIDES], f"""
SELECT city, "column" FROM (
  UNPIVOT (SELECT city, {', '.join(f'(min({c}) = max({c}) OR count({c}) = 0) AS {c}' for c in _NUMERIC_RIDE_COLS)}
           FROM rides WHERE city IS NOT NULL GROUP BY city)
  ON {', '.join(_NUMERIC_RIDE_COLS)} INTO NAME "column" VALUE is_constant)
WHERE coalesce(is_constant, true)""")

SQL["demand_distribution"] = q([RIDES, SHD], f"""
SELECT city, {r6('avg(demand)')} AS mean, {r6('median(demand)')} AS median,
       {r6('stddev_samp(demand)')} AS std, {r6('quantile_cont(demand, 0.95)')} AS p95,
       {r6('quantile_cont(demand, 0.99)')} AS p99, max(demand) AS max
FROM shd GROUP BY city""")
SQL["demand_histogram"] = q([RIDES, SHD], "SELECT city, demand, count(*) AS n FROM shd GROUP BY city, demand")

_HPQ = f"SELECT city, hour, rides, {r6('rides / max(rides) OVER (PARTITION BY city)')} AS share_of_max FROM hp"
SQL["hourly_pattern"] = q([RIDES, HP], _HPQ)
SQL["share_of_max"] = q([RIDES, HP], _HPQ)
SQL["hourly_peaks"] = q([RIDES, HP], """
SELECT city, arg_min(hour, (-rides, hour)) AS peak_hour, max(rides) AS peak_rides,
       arg_min(hour, (rides, hour)) AS quiet_hour, min(rides) AS quiet_rides
FROM hp GROUP BY city""")
SQL["hourly_by_daytype"] = q([RIDES], """
SELECT city, weekend, hour(hour_ts) AS hour, count(*) AS rides FROM rides
WHERE city IS NOT NULL AND weekend IS NOT NULL AND hour_ts IS NOT NULL GROUP BY ALL""")
SQL["rides_by_weekday"] = q([RIDES], """
SELECT d.city, d.weekday, coalesce(c.rides, 0) AS rides
FROM (SELECT city, unnest(range(0, 7)) AS weekday FROM (SELECT DISTINCT city FROM rides WHERE city IS NOT NULL)) d
LEFT JOIN (SELECT city, weekday, count(*) AS rides FROM rides
           WHERE city IS NOT NULL AND weekday IS NOT NULL GROUP BY ALL) c USING (city, weekday)""")
SQL["weekday_weekend_ratio"] = q([RIDES], f"""
SELECT city, weekday_rides, weekend_rides,
       CASE WHEN weekend_rides <> 0 THEN {r6('CAST(weekday_rides AS DOUBLE) / weekend_rides')} END AS ratio
FROM (SELECT city, count_if(weekend = 0) AS weekday_rides, count_if(weekend = 1) AS weekend_rides
      FROM rides WHERE city IS NOT NULL GROUP BY city)""")
SQL["hour_weekday_pivot"] = q([RIDES], f"""
SELECT city, hour(hour_ts) AS hour, {', '.join(f'count_if(weekday = {i}) AS wd_{i}' for i in range(7))}
FROM rides WHERE city IS NOT NULL AND weekday IS NOT NULL AND hour_ts IS NOT NULL GROUP BY ALL""")
_DD = "dd AS (SELECT city, date, count(*) AS rides FROM rides WHERE city IS NOT NULL AND date IS NOT NULL GROUP BY ALL)"
SQL["daily_demand"] = q([RIDES, _DD], "SELECT * FROM dd")
SQL["daily_summary"] = q([RIDES, _DD], f"""
SELECT city, min(rides) AS min_daily, max(rides) AS max_daily, {r6('avg(rides)')} AS mean_daily FROM dd GROUP BY city""")

_WL = f"""wl AS (SELECT city, "column", value FROM (
  UNPIVOT (SELECT city, {', '.join(WEATHER_COLS)} FROM rides WHERE city IS NOT NULL)
  ON {', '.join(WEATHER_COLS)} INTO NAME "column" VALUE value))"""
SQL["weather_summary"] = q([RIDES, _WL], f"""
SELECT city, "column", min(value) AS min, max(value) AS max, {r6('avg(value)')} AS mean FROM wl GROUP BY city, "column"
""")
SQL["density_histogram"] = q([RIDES, _WL], f"""
SELECT city, "column", bin, {r6('lo + bin * ((hi - lo) / 30)')} AS bin_lo,
       {r6('lo + (bin + 1) * ((hi - lo) / 30)')} AS bin_hi, count,
       {r6('count / (n * ((hi - lo) / 30))')} AS density
FROM (
  SELECT w.city, w."column", CAST(least(floor((w.value - r.lo) / ((r.hi - r.lo) / 30)), 29) AS INTEGER) AS bin,
         r.lo, r.hi, r.n, count(*) AS count
  FROM wl w JOIN (
    SELECT city, "column", CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
           CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi, count(*) AS n
    FROM wl WHERE value IS NOT NULL GROUP BY city, "column") r USING (city, "column")
  WHERE w.value IS NOT NULL GROUP BY ALL)""")
SQL["demand_by_weather"] = q([RIDES, DBW], f"SELECT * REPLACE ({t('hour_ts')}) FROM dbw")
SQL["binned_box_stats"] = q([RIDES, DBW, """bx AS (
  SELECT d.*, r.mn, r.mx,
         CASE WHEN (r.mx - r.mn) / 6 > 0
              THEN CAST(least(greatest(1, ceil((d.temperature_2m - r.mn) / ((r.mx - r.mn) / 6))), 6) AS INTEGER)
              ELSE 1 END AS bin
  FROM dbw d JOIN (SELECT city, min(temperature_2m) AS mn, max(temperature_2m) AS mx FROM dbw GROUP BY city) r
  USING (city))""", """bq AS (
  SELECT city, bin, count(*) AS n, quantile_cont(demand, 0.25) AS q1, median(demand) AS median,
         quantile_cont(demand, 0.75) AS q3, first(mn) AS mn, first(mx) AS mx
  FROM bx GROUP BY city, bin)"""], f"""
SELECT q.city, q.bin, q.n, {r6('q.q1')} AS q1, {r6('q.median')} AS median, {r6('q.q3')} AS q3,
       {r6('CASE WHEN q.bin = 1 THEN q.mn - (q.mx - q.mn) * 0.001 ELSE q.mn + (q.bin - 1) * (q.mx - q.mn) / 6 END')} AS bin_lo,
       {r6('q.mn + q.bin * (q.mx - q.mn) / 6')} AS bin_hi,
       w.whisker_lo, w.whisker_hi
FROM bq q JOIN (
  SELECT b.city, b.bin,
         min(CASE WHEN b.demand >= q.q1 - 1.5 * (q.q3 - q.q1) THEN CAST(b.demand AS DOUBLE) END) AS whisker_lo,
         max(CASE WHEN b.demand <= q.q3 + 1.5 * (q.q3 - q.q1) THEN CAST(b.demand AS DOUBLE) END) AS whisker_hi
  FROM bx b JOIN bq q USING (city, bin) GROUP BY b.city, b.bin) w USING (city, bin)""")

_CC = ["demand", "temperature_2m", "precipitation", "wind_speed_10m"]
_PAIRS = [(a, b) for i, a in enumerate(_CC) for b in _CC[i + 1:]]
SQL["correlation_matrix"] = q([RIDES, DBW], " UNION ALL ".join(
    f"SELECT city, '{a}' AS col_a, '{b}' AS col_b, {r6(pearson_sql(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)'))} AS r "
    f"FROM dbw GROUP BY city" for a, b in _PAIRS))

_ML = f"""ml AS (SELECT city, col_name AS "column", value FROM
  (SELECT city, {', '.join(POI_COLS)} FROM rides WHERE city IS NOT NULL)
  UNPIVOT INCLUDE NULLS (value FOR col_name IN ({', '.join(POI_COLS)})))"""
SQL["metadata_summary"] = q([RIDES, _ML], f"""
SELECT city, "column", (min(value) = max(value) OR count(value) = 0) AS is_constant, min(value) AS min,
       max(value) AS max, {r6('avg(value)')} AS mean, {r6('avg(CAST(value IS NULL AS DOUBLE)) * 100')} AS missing_pct
FROM ml GROUP BY city, "column"
""")
SQL["user_type_share"] = q([RIDES], f"""
SELECT city, user_type, rides, {r6('rides * 100.0 / sum(rides) OVER (PARTITION BY city)')} AS pct
FROM (SELECT city, coalesce(user_type, 'missing') AS user_type, count(*) AS rides FROM rides
      WHERE city IS NOT NULL GROUP BY ALL)""")
_SV = "sv AS (SELECT city, start_station_id, avg(demand) AS mean, stddev_samp(demand) AS std, max(demand) AS max FROM shd GROUP BY ALL)"
SQL["station_variability"] = q([RIDES, SHD, _SV], f"""
SELECT city, start_station_id, {r6('mean')} AS mean, {r6('std')} AS std, max FROM sv""")
SQL["station_variability_summary"] = q([RIDES, SHD, _SV], """
SELECT city, count(*) AS stations, count_if(mean > 5) AS stations_mean_gt_5, count_if(mean < 1) AS stations_mean_lt_1
FROM sv GROUP BY city""")
SQL["holiday_days"] = q([RIDES], """
SELECT city, count(DISTINCT CASE WHEN holiday = 1 THEN date END) AS holiday_dates, count(DISTINCT date) AS dates,
       array_to_string(list_sort(list_distinct(list(holiday_name))), '; ') AS holiday_names
FROM rides WHERE city IS NOT NULL GROUP BY city""")
SQL["reconcile_sources"] = q([RIDES, SUPPLEMENTAL] + table_ctes("o_", "rides")[:1] + table_ctes("s_", "supp_rides")[:1], """
SELECT city, station_key, coalesce(a.n, 0) AS rides_a, coalesce(b.n, 0) AS rides_b,
       a.n IS NOT NULL AND b.n IS NOT NULL AS in_both, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS abs_diff
FROM (SELECT city, station_key, count(*) AS n FROM o_keyed GROUP BY ALL) a
FULL OUTER JOIN (SELECT city, station_key, count(*) AS n FROM s_keyed GROUP BY ALL) b USING (city, station_key)""")
SQL["agreement_corr_weather"] = q(BASE + [WEATHER, f"""cht AS (
  SELECT city_key, strftime(target_hour_start, {SEC}) AS target_hour_start,
         arg_min(temperature_2m, ride_id) FILTER (WHERE temperature_2m IS NOT NULL) AS temperature_2m
  FROM keyed GROUP BY ALL)"""], f"""
SELECT c.city_key, {r6(pearson_sql('c.temperature_2m', 'w.temperature_2m'))} AS r
FROM cht c JOIN weather w ON c.target_hour_start = w.hour_ts GROUP BY c.city_key""")
SQL["agreement_corr_poi"] = q(BASE + [STATION_FEATURES, """smb AS (
  SELECT city_key, station_key,
         arg_min(bike_lane_length_500m, ride_id) FILTER (WHERE bike_lane_length_500m IS NOT NULL) AS a
  FROM keyed GROUP BY ALL)"""], f"""
SELECT city_key, {r6(pearson_sql('ra', 'rb'))} AS rank_corr FROM (
  SELECT city_key,
         rank() OVER (PARTITION BY city_key ORDER BY a) + (count(*) OVER (PARTITION BY city_key, a) - 1) / 2.0 AS ra,
         rank() OVER (PARTITION BY city_key ORDER BY b) + (count(*) OVER (PARTITION BY city_key, b) - 1) / 2.0 AS rb
  FROM (SELECT s.city_key, s.a, f.bike_lane_length_500m AS b
        FROM smb s JOIN station_features f ON s.station_key = f.start_station_id))
GROUP BY city_key""")
SQL["acf_hourly"] = q([RIDES, """ch AS (
  SELECT city, hour_ts, n, row_number() OVER (PARTITION BY city ORDER BY hour_ts) AS pos
  FROM (SELECT city, hour_ts, count(*) AS n FROM rides WHERE city IS NOT NULL AND hour_ts IS NOT NULL GROUP BY ALL))"""], f"""
SELECT city, lag, {r6('acf')} AS acf, abs(acf) > 0.2 AS strong FROM (
  SELECT a.city, l.lag, {pearson_sql('CAST(b.n AS DOUBLE)', 'CAST(a.n AS DOUBLE)')} AS acf
  FROM ch a, (SELECT unnest(range(1, 49)) AS lag) l
  JOIN ch b ON b.city = a.city AND b.pos = a.pos + l.lag
  GROUP BY a.city, l.lag)""")
SQL["top_stations"] = q([RIDES], """
SELECT * FROM (
  SELECT city, start_station_id, rides,
         row_number() OVER (PARTITION BY city ORDER BY rides DESC, start_station_id) AS rank
  FROM (SELECT city, start_station_id, count(*) AS rides FROM rides
        WHERE city IS NOT NULL AND start_station_id IS NOT NULL GROUP BY ALL))
WHERE rank <= 10""")
SQL["top_station_hours"] = q([RIDES, SHD], f"""
SELECT city, start_station_id, {t('hour_ts')}, demand FROM shd
ORDER BY demand DESC, city, start_station_id, hour_ts LIMIT 20""")


# --- batch 5: spatial layers and enrichment ---------------------------------------------
from dockhour.operators.enrich import COUNT_SPECS  # noqa: E402
from dockhour.operators.spatial import POI_RULES  # noqa: E402
from dockhour.schemas import ENRICHED_OUT_COLS, POI8_COLS, POI_COUNT_COLS  # noqa: E402

D = lambda x: f"CAST({x} AS DOUBLE)"

POI_EL = f"""poi_el AS (
  SELECT c_custkey AS element_id,
    CASE WHEN c_custkey % 4 = 3 THEN 'way' ELSE 'node' END AS element_type,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'highway' WHEN 'BUILDING' THEN 'office'
         WHEN 'FURNITURE' THEN 'shop' WHEN 'HOUSEHOLD' THEN 'amenity'
         ELSE CASE WHEN c_custkey % 5 = 0 THEN 'railway' ELSE 'amenity' END END AS tag_key,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'bus_stop' WHEN 'BUILDING' THEN 'company'
         WHEN 'FURNITURE' THEN 'furniture'
         WHEN 'HOUSEHOLD' THEN CASE WHEN c_custkey % 2 = 0 THEN 'restaurant' ELSE 'cafe' END
         ELSE CASE WHEN c_custkey % 5 = 0 THEN 'station' ELSE 'university' END END AS tag_value,
    {D(38.78)} + CAST(c_custkey % 97 AS DOUBLE) * {D(0.0007)} AS lat,
    {D(-77.12)} + CAST((c_custkey * 7) % 89 AS DOUBLE) * {D(0.0009)} AS lon
  FROM customer)"""

LINE_EL = f"""line_el AS (
  SELECT p_partkey AS element_id, 'highway' AS tag_key, 'cycleway' AS tag_value, 1 AS seq,
    {D(38.79)} + CAST(p_partkey % 53 AS DOUBLE) * {D(0.001)} AS lat0,
    {D(-77.11)} + CAST(p_partkey % 59 AS DOUBLE) * {D(0.001)} AS lon0,
    {D(38.79)} + CAST(p_partkey % 53 AS DOUBLE) * {D(0.001)} + CAST(p_size AS DOUBLE) * {D(0.0001)} AS lat1,
    {D(-77.11)} + CAST(p_partkey % 59 AS DOUBLE) * {D(0.001)} + CAST((p_size % 7) - 3 AS DOUBLE) * {D(0.0002)} AS lon1
  FROM part WHERE p_type IN ('ECONOMY', 'STANDARD', 'SMALL'))"""

POLY_EL = f"""poly_v AS (
  SELECT p_partkey AS element_id,
    {D(38.79)} + CAST(p_partkey % 47 AS DOUBLE) * {D(0.001)} AS a,
    {D(-77.11)} + CAST(p_partkey % 61 AS DOUBLE) * {D(0.001)} AS b,
    CAST(p_size AS DOUBLE) * {D(0.0002)} AS s
  FROM part WHERE p_type IN ('MEDIUM', 'PROMO', 'LARGE')),
poly_edges AS (
  SELECT element_id, 1 AS seq, a AS lat0, b AS lon0, a + s AS lat1, b AS lon1 FROM poly_v
  UNION ALL SELECT element_id, 2, a + s, b, a, b + s FROM poly_v
  UNION ALL SELECT element_id, 3, a, b + s, a, b FROM poly_v)"""


def _rule_sql(rules=POI_RULES):
    parts = []
    for cat, tag_rules in rules.items():
        conds = []
        for key, rule in tag_rules.items():
            if rule is True:
                conds.append(f"tag_key = '{key}'")
            elif isinstance(rule, str):
                conds.append(f"(tag_key = '{key}' AND regexp_matches(tag_value, '{rule}'))")
            else:
                conds.append(f"(tag_key = '{key}' AND tag_value IN ({', '.join(repr(v) for v in rule)}))")
        parts.append((cat, " OR ".join(conds)))
    return parts


def categories_sql(src: str) -> str:
    return " UNION ALL ".join(f"SELECT element_id, '{cat}' AS category FROM {src} WHERE {cond}"
                              for cat, cond in _rule_sql())


def poi_ctes(stations: str) -> list[str]:
    """Projected stations (st), categorised points (pts), line and polygon edges in metres."""
    x, y = aeqd_sql("lat", "lng", "c.lat0", "c.lng0")
    px, py = aeqd_sql("p.lat", "p.lon", "c.lat0", "c.lng0")
    ex0, ey0 = aeqd_sql("e.lat0", "e.lon0", "c.lat0", "c.lng0")
    ex1, ey1 = aeqd_sql("e.lat1", "e.lon1", "c.lat0", "c.lng0")
    return [
        POI_EL, LINE_EL, POLY_EL,
        f"ctr AS (SELECT avg(lat) AS lat0, avg(lng) AS lng0 FROM {stations})",
        f"st AS (SELECT s.station_id, s.lat, s.lng, {x} AS x, {y} AS y FROM {stations} s, ctr c)",
        f"pcat AS ({categories_sql('poi_el')})",
        f"pts AS (SELECT k.category, {px} AS px, {py} AS py FROM poi_el p JOIN pcat k USING (element_id), ctr c)",
        f"""ledges AS (SELECT e.element_id, {ex0} AS x0, {ey0} AS y0, {ex1} AS x1, {ey1} AS y1
             FROM line_el e JOIN ({categories_sql('line_el')}) k USING (element_id), ctr c WHERE k.category = 'cycle')""",
        f"""pedges AS (SELECT e.element_id, {ex0} AS x0, {ey0} AS y0, {ex1} AS x1, {ey1} AS y1
             FROM poly_edges e, ctr c)""",
    ]


def _counts_sql():
    cols = ", ".join(
        f"count_if(p.category = '{cat}' AND (p.px - s.x) * (p.px - s.x) + (p.py - s.y) * (p.py - s.y) "
        f"<= CAST({r * r} AS DOUBLE)) AS {col}" for col, cat, r in COUNT_SPECS)
    return f"cnt AS (SELECT s.station_id, {cols} FROM st s, pts p GROUP BY s.station_id)"


NEAR = """near AS (
  SELECT s.station_id, CASE WHEN s.x IS NULL THEN NULL
                            WHEN min(sqrt((p.px - s.x) * (p.px - s.x) + (p.py - s.y) * (p.py - s.y))) IS NULL THEN -1.0
                            ELSE round_even(min(sqrt((p.px - s.x) * (p.px - s.x) + (p.py - s.y) * (p.py - s.y))), 1) END
         AS distance_to_nearest_rail_station
  FROM st s LEFT JOIN pts p ON p.category = 'rail' GROUP BY s.station_id, s.x)"""


def _chord(r):
    ax, ay, bx, by = "(e.x0 - s.x)", "(e.y0 - s.y)", "(e.x1 - s.x)", "(e.y1 - s.y)"
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    a = f"({dx} * {dx} + {dy} * {dy})"
    b = f"(2 * ({ax} * {dx} + {ay} * {dy}))"
    c = f"({ax} * {ax} + {ay} * {ay} - CAST({r * r} AS DOUBLE))"
    disc = f"({b} * {b} - 4 * {a} * {c})"
    sq = f"sqrt(greatest({disc}, 0.0))"
    t1 = f"((-{b} - {sq}) / (2 * {a}))"
    t2 = f"((-{b} + {sq}) / (2 * {a}))"
    return ax, ay, bx, by, dx, dy, a, disc, t1, t2


def _len_sql(r=500.0):
    *_, a, disc, t1, t2 = _chord(r)
    seg = (f"CASE WHEN {a} > 0 AND {disc} > 0 THEN greatest(least({t2}, 1.0) - greatest({t1}, 0.0), 0.0) "
           f"* sqrt({a}) ELSE 0.0 END")
    return f"""len AS (
  SELECT s.station_id, CASE WHEN s.x IS NULL THEN NULL ELSE round_even(coalesce(sum({seg}), 0.0), 1) END
         AS bike_lane_length_500m
  FROM st s LEFT JOIN ledges e ON true GROUP BY s.station_id, s.x)"""


def _area_sql(r=500.0):
    ax, ay, bx, by, dx, dy, a, disc, t1, t2 = _chord(r)
    hit = f"({a} > 0 AND {disc} > 0)"
    tlo = f"(CASE WHEN {hit} THEN least(greatest({t1}, 0.0), 1.0) ELSE 0.0 END)"
    thi = f"(CASE WHEN {hit} THEN least(greatest({t2}, 0.0), 1.0) ELSE 0.0 END)"
    plx, ply = f"({ax} + {tlo} * {dx})", f"({ay} + {tlo} * {dy})"
    phx, phy = f"({ax} + {thi} * {dx})", f"({ay} + {thi} * {dy})"

    def sector(ux, uy, vx, vy):
        return f"(CAST({0.5 * r * r} AS DOUBLE) * atan2({ux} * {vy} - {uy} * {vx}, {ux} * {vx} + {uy} * {vy}))"
    signed = (f"{sector(ax, ay, plx, ply)} + 0.5 * ({plx} * {phy} - {ply} * {phx}) + "
              f"{sector(phx, phy, bx, by)}")
    return f"""area AS (
  SELECT s.station_id, CASE WHEN s.x IS NULL THEN NULL ELSE round_even(coalesce(sum(pa), 0.0), 1) END AS park_area_500m
  FROM st s LEFT JOIN (
    SELECT s.station_id, e.element_id, abs(sum({signed})) AS pa
    FROM st s, pedges e WHERE s.x IS NOT NULL GROUP BY s.station_id, e.element_id) q USING (station_id)
  GROUP BY s.station_id, s.x)"""


STATIONS = """stations AS (SELECT start_station_id AS station_id, lat, lng FROM station_features)"""
POI_FEATS = [_counts_sql(), NEAR, _len_sql(), _area_sql(), """poi AS (
  SELECT station_id, len.bike_lane_length_500m, area.park_area_500m, cnt.university_count_1000m,
         cnt.office_poi_count_1000m, cnt.retail_poi_count_1000m, cnt.restaurant_cafe_count_500m,
         cnt.transit_stop_count_500m, near.distance_to_nearest_rail_station
  FROM cnt JOIN near USING (station_id) JOIN len USING (station_id) JOIN area USING (station_id))"""]
POI_ALL = [STATION_FEATURES, STATIONS] + poi_ctes("stations") + POI_FEATS

SQL["osm_elements_to_points"] = q([POI_EL], "SELECT element_id, element_type, lat, lon FROM poi_el")
SQL["osm_elements_to_segments"] = q([LINE_EL], "SELECT element_id, seq, lat0, lon0, lat1, lon1 FROM line_el")
SQL["osm_polygon_edges"] = q([POLY_EL], "SELECT element_id, seq, lat0, lon0, lat1, lon1 FROM poly_edges")
SQL["poi_category_match"] = q([POI_EL, LINE_EL, POLY_EL, """poly_el AS (
  SELECT element_id, 'leisure' AS tag_key, 'park' AS tag_value FROM poly_v)"""], f"""
SELECT 'point' AS layer, * FROM ({categories_sql('poi_el')})
UNION ALL SELECT 'line' AS layer, * FROM ({categories_sql('line_el')})
UNION ALL SELECT 'polygon' AS layer, * FROM ({categories_sql('poly_el')})""")
SQL["radius_count"] = q(POI_ALL, "SELECT * FROM cnt")
SQL["nearest_distance"] = q(POI_ALL, "SELECT * FROM near")
SQL["line_length_in_radius"] = q(POI_ALL, "SELECT * FROM len")
SQL["polygon_area_in_radius"] = q(POI_ALL, "SELECT * FROM area")
SQL["poi_features"] = q(POI_ALL, "SELECT * FROM poi")

CENTROID = "cen AS (SELECT median(start_lat) AS lat0, median(start_lng) AS lng0 FROM rides)"
SQL["distance_to_center"] = q([RIDES, STATION_FEATURES, CENTROID], f"""
SELECT start_station_id AS station_id, round_even({haversine_sql('lat', 'lng', 'c.lat0', 'c.lng0')}, 1) AS distance_to_city_center
FROM station_features, cen c""")
SQL["station_median_coords"] = q([RIDES], f"""
SELECT start_station_id, {r6('median(start_lat)')} AS start_lat, {r6('median(start_lng)')} AS start_lng
FROM rides GROUP BY start_station_id""")
SQL["city_centroid"] = q([RIDES, CENTROID], f"SELECT {r6('lat0')} AS lat0, {r6('lng0')} AS lng0 FROM cen")
SQL["tile_stations"] = q([STATION_FEATURES], f"""
SELECT CAST(round_even(lat / {D(0.035)}, 0) AS INTEGER) AS gx, CAST(round_even(lng / {D(0.035)}, 0) AS INTEGER) AS gy,
       count(*) AS stations, {r6(f'min(lat) - {D(0.013)}')} AS south, {r6(f'min(lng) - {D(0.013)}')} AS west,
       {r6(f'max(lat) + {D(0.013)}')} AS north, {r6(f'max(lng) + {D(0.013)}')} AS east
FROM station_features WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY ALL""")

SRC = f"""src AS (
  SELECT station_key AS station_id, {firsts(POI8_COLS)} FROM keyed WHERE city_key = 'click' GROUP BY station_key)"""
PAIRED = ["srcp AS (SELECT * FROM src WHERE station_id IN (SELECT station_id FROM poi))",
          "ownp AS (SELECT * FROM poi WHERE station_id IN (SELECT station_id FROM src))"]


def _factor(c):
    if c == "distance_to_nearest_rail_station":
        return f"CAST(1.0 AS DOUBLE) AS {c}"
    mt = f"(SELECT median({c}) FILTER (WHERE {c} > 0) FROM srcp)"
    mk = f"(SELECT median({c}) FILTER (WHERE {c} > 0) FROM ownp)"
    return f"CASE WHEN {mk} > 0 THEN {mt} / {mk} ELSE 1.0 END AS {c}"


FACTORS = f"factors AS (SELECT {', '.join(_factor(c) for c in POI8_COLS)})"
CAL_CTES = BASE + POI_ALL + [SRC] + PAIRED + [FACTORS]


def _cal(c):
    v = f"CASE WHEN f.{c} <> 1.0 THEN round_even(p.{c} * f.{c}, 1) ELSE p.{c} END"
    if c in POI_COUNT_COLS:
        return f"CAST(round_even({v}, 0) AS BIGINT) AS {c}"
    return f"{v} AS {c}"


CALIB = f"calib AS (SELECT p.station_id, {', '.join(_cal(c) for c in POI8_COLS)} FROM poi p, factors f)"
SQL["positive_median_ratio"] = q(CAL_CTES, f"SELECT {', '.join(f'{r6(c)} AS {c}' for c in POI8_COLS)} FROM factors")
SQL["poi_calibrate"] = q(CAL_CTES + [CALIB], "SELECT * FROM calib")
SQL["replace_columns"] = q(CAL_CTES + [CALIB], f"""
SELECT b.start_station_id, b.lat, b.lng, {', '.join('c.' + x for x in POI8_COLS)}, b.distance_to_city_center
FROM station_features b LEFT JOIN calib c ON b.start_station_id = c.station_id""")
SQL["poi_sanity"] = q(BASE + POI_ALL + [f"""smeta8 AS (
  SELECT city_key AS city, station_key, {firsts(POI8_COLS)} FROM keyed GROUP BY city_key, station_key)"""],
    " UNION ALL ".join(
        [f"SELECT 'own' AS city, '{c}' AS \"column\", {r6(f'median(CAST({c} AS DOUBLE)) FILTER (WHERE {c} > 0)')} AS median_positive FROM poi" for c in POI8_COLS]
        + [f"SELECT city, '{c}' AS \"column\", {r6(f'median(CAST({c} AS DOUBLE)) FILTER (WHERE {c} > 0)')} AS median_positive FROM smeta8 GROUP BY city" for c in POI8_COLS]))

CAL_SELECT = f"""strftime(t, '%Y-%m-%d') AS date, CAST(isodow(t) - 1 AS INTEGER) AS weekday,
    CAST(isodow(t) - 1 >= 5 AS INTEGER) AS weekend, CAST(({{hol}}) IS NOT NULL AS INTEGER) AS holiday,
    {{hol}} AS holiday_name, CAST(NOT (isodow(t) - 1 >= 5) AND ({{hol}}) IS NULL AS INTEGER) AS working_day"""
_HOL = holiday_name_sql_ = None
from dockhour.functions.holidays import holiday_name_sql as _hns  # noqa: E402
CAL_T = CAL_SELECT.format(hol=_hns("CAST(t AS DATE)"))

ENR = f"""enr AS (
  SELECT r.rental_id, strftime(r.t, {MIC}) AS started_at, r.start_station_name,
         {numeric_id_sql('r.start_station_id')} AS start_station_id,
         f.lat AS start_lat, f.lng AS start_lng, {', '.join('f.' + x for x in POI_COLS)},
         {CAL_T.replace('(t', '(r.t').replace(' t)', ' r.t)')},
         strftime(date_trunc('hour', r.t), {SEC}) AS hour_ts,
         {', '.join('w.' + x for x in WEATHER_COLS)}, 'city 1' AS city
  FROM (SELECT *, CAST(started_at AS TIMESTAMP) AS t FROM start_side) r
  LEFT JOIN station_features f ON {numeric_id_sql('r.start_station_id')} = {numeric_id_sql('f.start_station_id')}
  LEFT JOIN weather w ON w.hour_ts = strftime(date_trunc('hour', r.t), {SEC}))"""
SQL["enrich_rides"] = q([RIDES, START_SIDE, STATION_FEATURES, WEATHER, ENR], "SELECT * FROM enr")
SQL["coverage_pct"] = q([RIDES, START_SIDE, STATION_FEATURES, WEATHER, ENR], f"""
SELECT {r6('avg(CAST(office_poi_count_1000m IS NOT NULL AS DOUBLE)) * 100')} AS office_poi_count_1000m_coverage_pct,
       {r6('avg(CAST(temperature_2m IS NOT NULL AS DOUBLE)) * 100')} AS temperature_2m_coverage_pct FROM enr""")

CITY_FEATS = """city_feats AS (
  SELECT cs.city, f.* FROM (SELECT DISTINCT event_type AS city, CAST(user_id % 25 AS VARCHAR) AS sid FROM events) cs
  JOIN station_features f ON f.start_station_id = cs.sid)"""
CITY_WEATHER = f"""city_weather AS (
  SELECT ch.city, w.* REPLACE (w.temperature_2m + CAST(length(ch.city) AS DOUBLE) AS temperature_2m)
  FROM (SELECT DISTINCT event_type AS city, strftime(date_trunc('hour', ts), {SEC}) AS hour_ts FROM events) ch
  JOIN weather w USING (hour_ts))"""
_EOUT = {"started_at": f"strftime(r.t, {MIC})", "hour_ts": f"strftime(date_trunc('hour', r.t), {SEC})",
         "city": "r.city", "start_station_id": numeric_id_sql("r.start_station_id"),
         "start_station_name": "r.start_station_name", "start_lat": "f.lat", "start_lng": "f.lng"}
_CAL_R = CAL_T.replace("(t", "(r.t").replace(" t)", " r.t)")
SQL["enrich_fullyear"] = q([RIDES, START_SIDE, STATION_FEATURES, WEATHER, CITY_FEATS, CITY_WEATHER], f"""
SELECT {', '.join(f'{_EOUT[c]} AS {c}' for c in ENRICHED_OUT_COLS[:7])},
       {', '.join('w.' + x for x in WEATHER_COLS)}, {', '.join('f.' + x for x in POI_COLS)},
       {_CAL_R}
FROM (SELECT *, CAST(started_at AS TIMESTAMP) AS t FROM start_side) r
LEFT JOIN city_feats f ON f.city = r.city AND {numeric_id_sql('f.start_station_id')} = {numeric_id_sql('r.start_station_id')}
LEFT JOIN city_weather w ON w.city = r.city AND w.hour_ts = strftime(date_trunc('hour', r.t), {SEC})""")


def _city_cols(have: dict) -> str:
    out = []
    for c in RIDE_COLS:
        if c in have:
            out.append(f"{have[c]} AS {c}")
        else:
            typ = "VARCHAR" if c in _STR else ("INTEGER" if c in _INT else "DOUBLE")
            out.append(f"CAST(NULL AS {typ}) AS {c}")
    return ", ".join(out)


_CITY_HAVE = {"started_at": f"strftime(r.t, {MIC})", "start_station_id": "r.start_station_id",
              "city": "'city 4'", "date": "strftime(r.t, '%Y-%m-%d')",
              "weekday": "CAST(isodow(r.t) - 1 AS INTEGER)", "weekend": "CAST(isodow(r.t) - 1 >= 5 AS INTEGER)",
              "holiday": f"CAST(({_hns('CAST(r.t AS DATE)')}) IS NOT NULL AS INTEGER)",
              "holiday_name": _hns("CAST(r.t AS DATE)"),
              "working_day": f"CAST(NOT (isodow(r.t) - 1 >= 5) AND ({_hns('CAST(r.t AS DATE)')}) IS NULL AS INTEGER)",
              "hour_ts": f"strftime(date_trunc('hour', r.t), {SEC})"}
SQL["enrich_city"] = q([RIDES, START_SIDE, WEATHER], f"""
SELECT {_city_cols({**_CITY_HAVE, 'start_lat': 'r.start_lat', 'start_lng': 'r.start_lng',
                   **{c: 'w.' + c for c in WEATHER_COLS}})}
FROM (SELECT *, CAST(started_at AS TIMESTAMP) AS t FROM start_side) r
LEFT JOIN weather w ON w.hour_ts = strftime(date_trunc('hour', r.t), {SEC})""")

SCATTERED = f"""start_side AS (
  SELECT ride_id AS rental_id, strftime(started_at, {MIC}) AS started_at,
         CASE WHEN ride_id % 53 <> 0 THEN start_station_id END AS start_station_id,
         start_lat + CAST(ride_id % 7 AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS start_lat,
         start_lng - CAST(ride_id % 7 AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS start_lng
  FROM rides)"""
# POI follow the station, where rides without one share one; coordinates are the ride's own.
RAW_STATIONS = """raw_stations AS (
  SELECT coalesce(start_station_id, '(no station)') AS station_id, median(start_lat) AS lat,
         median(start_lng) AS lng
  FROM start_side GROUP BY 1)"""
SQL["enrich_city_poi"] = q([RIDES, SCATTERED, RAW_STATIONS] + poi_ctes("raw_stations") + POI_FEATS + [
    "cen AS (SELECT median(start_lat) AS lat0, median(start_lng) AS lng0 FROM start_side)"], f"""
SELECT {_city_cols({**_CITY_HAVE, 'start_lat': 'r.start_lat', 'start_lng': 'r.start_lng',
                   **{c: 'p.' + c for c in POI8_COLS},
                   'distance_to_city_center': f"round_even({haversine_sql('s.lat', 's.lng', 'c.lat0', 'c.lng0')}, 1)"})}
FROM (SELECT *, CAST(started_at AS TIMESTAMP) AS t FROM start_side) r
LEFT JOIN raw_stations s ON s.station_id = coalesce(r.start_station_id, '(no station)')
LEFT JOIN poi p ON p.station_id = coalesce(r.start_station_id, '(no station)')
CROSS JOIN cen c""")

SQL["us_holiday_dim"] = q([RIDES], f"""
SELECT strftime(day, '%Y-%m-%d') AS day, {_hns('day')} AS holiday_name, CAST(({_hns('day')}) IS NOT NULL AS INTEGER) AS holiday
FROM (SELECT CAST(unnest(generate_series(min(started_at)::DATE, max(started_at)::DATE, INTERVAL 1 DAY)) AS DATE) AS day
      FROM rides)""")


# --- batch 6: file sources and sinks ------------------------------------------------------
_RC = {c for c in RIDE_COLS}


def _rides_as_csv(src):
    out = []
    for c in RIDE_COLS:
        if c == "ended_at":
            out.append("CAST(NULL AS VARCHAR) AS ended_at")
        elif c == "started_at":
            out.append(f"strftime(started_at, {MIC}) AS started_at")
        elif c == "hour_ts":
            out.append(f"strftime(hour_ts, {SEC}) AS hour_ts")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM {src}"


SQL["scan_rides_csv"] = q([RIDES], _rides_as_csv("rides"))
SQL["ingest_alias_headers"] = q([RIDES, START_SIDE, SUPPLEMENTAL], f"""
SELECT CAST(rental_id AS VARCHAR) AS rental_id, started_at, start_station_id, start_station_name FROM start_side
UNION ALL
SELECT CAST(ride_id AS VARCHAR), strftime(started_at, {MIC}), start_station_id, 'Station ' || trim(start_station_id)
FROM supp_rides""")
SQL["scan_gzip_chunks"] = q([RIDES, START_SIDE], """
SELECT CAST(rental_id AS VARCHAR) AS rental_id, started_at, start_station_id, start_station_name, city FROM start_side""")
SQL["scan_station_features"] = q([STATION_FEATURES], """
SELECT * RENAME (lat AS start_lat, lng AS start_lng) FROM station_features""")
SQL["scan_weather_csv"] = q([WEATHER], "SELECT * FROM weather")
SQL["weather_json_unnest"] = q([WEATHER], "SELECT * FROM weather")
SQL["discover_sources"] = q([RIDES, SUPPLEMENTAL], f"""
SELECT 'a_official.csv' AS source, strftime(started_at, {MIC}) AS started_at, start_station_id, city FROM rides
UNION ALL
SELECT 'b_supplemental.csv', strftime(started_at, {MIC}), start_station_id, city FROM supp_rides""")
SQL["ingest_zipped_trips"] = q([RIDES, START_SIDE], """
SELECT rental_id::VARCHAR AS rental_id, substr(started_at, 1, 19) AS started_at, start_station_id,
       start_station_name FROM start_side""")
SQL["materialise_table"] = SQL["station_hour_table"]
SQL["write_targets_labels"] = SQL["public_private_split"]
SQL["write_split_files"] = SQL["load_splits"]
SQL["ingest_report_months"] = q([RIDES, START_SIDE], """
SELECT substr(started_at, 1, 7) AS month, count(*) AS rides FROM start_side GROUP BY 1""")
SQL["ingest_report_totals"] = q([RIDES, START_SIDE], """
SELECT count(*) AS rides, count(DISTINCT start_station_id) AS stations FROM start_side""")


# --- batch 8 --------------------------------------------------------------------------------
SQL["score_by_city"] = q(TARGET_CTES + [PREDS, SCORED, summary_cte()], """
SELECT * EXCLUDE (negative_predictions_before_clipping) FROM summary WHERE city <> 'OVERALL'""")
SQL["negatives_before_clip"] = q(TARGET_CTES + [PREDS, SCORED, summary_cte()], """
SELECT model, negative_predictions_before_clipping FROM summary WHERE city = 'OVERALL'""")
SQL["write_summary_scored"] = SQL["leaderboard_sort"]
SQL["write_enriched"] = SQL["enrich_fullyear"]
SQL["leak_guard"] = q(POOL_CTES, """
SELECT city_key, array_to_string(list_sort(list_distinct(list(split))), ',') AS splits FROM splits GROUP BY city_key""")
