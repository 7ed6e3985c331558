"""Time parts, cyclical encodings, calendar fields and text formats."""
from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .holidays import us_holiday_name
from .keys import floor_hour


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_in(ts, keep_hours) -> Column:
    """Hour-of-day membership; ``None`` keeps everything; out-of-range hours are an error."""
    if keep_hours is None:
        return F.lit(True)
    hours = sorted({int(h) for h in keep_hours})
    bad = [h for h in hours if h < 0 or h > 23]
    if bad:
        raise ValueError(f"Invalid keep_hours values: {bad}")
    return F.hour(_col(ts)).isin(hours)


def time_parts(ts) -> dict[str, Column]:
    """hour, weekday (Mon=0), is_weekend, how = weekday*24 + hour."""
    t = _col(ts)
    hour = F.hour(t).cast("bigint")
    wd = F.weekday(t).cast("bigint")
    return {
        "hour": hour,
        "weekday": wd,
        "is_weekend": F.when(wd >= 5, 1).otherwise(0).cast("bigint"),
        "how": wd * 24 + hour,
    }


def cyclical_time(ts, hour=None, weekday=None) -> dict[str, Column]:
    """sin/cos of hour (period 24) and weekday (period 7), month and day of year."""
    t = _col(ts)
    h = _col(hour).cast("double") if hour is not None else F.hour(t).cast("double")
    w = _col(weekday).cast("double") if weekday is not None else F.weekday(t).cast("double")
    two_pi = 2 * math.pi
    return {
        "hour_sin": F.sin(F.lit(two_pi) * h / 24),
        "hour_cos": F.cos(F.lit(two_pi) * h / 24),
        "dow_sin": F.sin(F.lit(two_pi) * w / 7),
        "dow_cos": F.cos(F.lit(two_pi) * w / 7),
        "month": F.month(t).cast("bigint"),
        "day_of_year": F.dayofyear(t).cast("bigint"),
    }


def format_ts(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def format_date(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def calendar_fields(ts) -> dict[str, Column]:
    """date, weekday, weekend, holiday, holiday_name (US), working_day, hour_ts.

    A NULL time gives weekend 0, holiday 0, working_day 1 (flags are computed
    as comparisons that are false on a missing value).
    """
    t = _col(ts)
    wd = F.weekday(t)
    name = us_holiday_name(ts if isinstance(ts, str) else F.to_date(t))
    weekend = F.coalesce((wd >= 5).cast("int"), F.lit(0))
    holiday = name.isNotNull().cast("int")
    return {
        "date": format_date(t),
        "weekday": wd,
        "weekend": weekend,
        "holiday": holiday,
        "holiday_name": name,
        "working_day": ((weekend == 0) & (holiday == 0)).cast("int"),
        "hour_ts": floor_hour(t),
    }
