"""Keys, lenient parsing, calendar and rounding."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from dockhour.functions.holidays import us_holiday_name
from dockhour.functions.keys import normalize_station_id, numeric_coerce
from dockhour.functions.time import calendar_fields, time_parts
from dockhour.operators.keys import key_rides


def test_station_id_normalisation(spark):
    cases = {"31631": "31631", "31631.0": "31631", " 00123": "123", "1e3": "1000", "-0": "0", "+7": "7",
             "\t42 ": "42", "5.": "5"}
    kept = ["1d", "0x1A", "inf", "nan", "", "12.5", "1_0", "station_7"]
    rows = [(k,) for k in list(cases) + kept] + [(None,)]
    df = spark.createDataFrame(rows, "s string").select("s", normalize_station_id("s").alias("k"))
    got = {r.s: r.k for r in df.collect()}
    for raw, want in cases.items():
        assert got[raw] == want, raw
    for raw in kept:
        assert got[raw] == raw, raw
    assert got[None] == "__missing_station__"


def test_numeric_coerce(spark):
    df = spark.createDataFrame([(" 7",), ("1d",), ("2.5",), ("nan",), (None,)], "s string")
    got = [r[0] for r in df.select(numeric_coerce("s")).collect()]
    assert got == [7.0, None, 2.5, None, None]


def test_calendar_null_time(spark):
    df = spark.createDataFrame([(None,)], "t timestamp_ntz")
    cal = calendar_fields(F.col("t"))
    r = df.select(*[v.alias(k) for k, v in cal.items()]).first()
    assert (r.weekend, r.holiday, r.working_day) == (0, 0, 1)
    assert r.date is None and r.hour_ts is None


@pytest.mark.parametrize("day,name", [
    ("2024-01-01", "New Year's Day"), ("2024-01-15", "Martin Luther King Jr. Day"),
    ("2024-02-19", "Washington's Birthday"), ("2024-05-27", "Memorial Day"),
    ("2024-06-19", "Juneteenth National Independence Day"), ("2024-07-04", "Independence Day"),
    ("2024-09-02", "Labor Day"), ("2024-10-14", "Columbus Day"), ("2024-11-11", "Veterans Day"),
    ("2024-11-28", "Thanksgiving Day"), ("2024-12-25", "Christmas Day"),
    ("2021-12-31", "New Year's Day (observed)"), ("2023-01-02", "New Year's Day (observed)"),
    ("2024-01-16", None), ("2020-06-19", None)])
def test_us_holidays(spark, day, name):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert df.select(us_holiday_name("d")).first()[0] == name            # SQL-expression path
    assert df.select(us_holiday_name(F.col("d"))).first()[0] == name     # Column path


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 7, 23),)], "t timestamp_ntz")
    tp = time_parts("t")
    rows = df.select(*[v.alias(k) for k, v in tp.items()]).collect()
    assert [(r.weekday, r.hour, r.is_weekend, r.how) for r in rows] == [(0, 10, 0, 10), (6, 23, 1, 167)]


def test_time_column_chosen_by_presence(spark):
    # hour_ts present but NULL does not fall back to started_at: strict builder raises
    df = spark.createDataFrame([("1", dt.datetime(2024, 1, 1, 10, 5), None, "c")],
                               "start_station_id string, started_at timestamp_ntz, hour_ts timestamp_ntz, city string")
    with pytest.raises(Exception):
        key_rides(df, strict=True).collect()
    assert key_rides(df, strict=False).count() == 0


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(F.bround("x", 0)).collect()] == [0.0, 2.0, 2.0]
