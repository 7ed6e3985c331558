"""US federal holidays as a pure column expression (H4).

No dimension table and no join: every rule is a predicate on the date itself,
so the calendar step is a narrow projection at any scale.

FIXED VALUES: holiday names (public US federal calendar).
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# FIXED VALUES: fixed-date holidays (month, day, name, first year)
FIXED_DATE_HOLIDAYS = [
    (1, 1, "New Year's Day", 1871),
    (6, 19, "Juneteenth National Independence Day", 2021),
    (7, 4, "Independence Day", 1871),
    (11, 11, "Veterans Day", 1938),
    (12, 25, "Christmas Day", 1871),
]
# FIXED VALUES: floating holidays (month, weekday Mon=0, nth or -1 for last, name)
FLOATING_HOLIDAYS = [
    (1, 0, 3, "Martin Luther King Jr. Day"),
    (2, 0, 3, "Washington's Birthday"),
    (5, 0, -1, "Memorial Day"),
    (9, 0, 1, "Labor Day"),
    (10, 0, 2, "Columbus Day"),
    (11, 3, 4, "Thanksgiving Day"),
]
OBSERVED_SUFFIX = " (observed)"


def _q(name: str) -> str:
    return "'" + name.replace("'", "\\'") + "'"


def _fixed_sql(x: str) -> str:
    parts = [f"WHEN month({x}) = {m} AND dayofmonth({x}) = {dd} AND year({x}) >= {since} THEN {_q(n)}"
             for m, dd, n, since in FIXED_DATE_HOLIDAYS]
    return "CASE " + " ".join(parts) + " END"


def holiday_spark_sql(d: str) -> str:
    """The rules as one Spark SQL expression over a DATE expression ``d``."""
    wd = f"weekday({d})"
    floats = []
    for month, weekday, nth, name in FLOATING_HOLIDAYS:
        if nth == -1:
            cond = f"month({d}) = {month} AND {wd} = {weekday} AND dayofmonth({d}) + 7 > dayofmonth(last_day({d}))"
        else:
            cond = f"month({d}) = {month} AND {wd} = {weekday} AND div(dayofmonth({d}) - 1, 7) = {nth - 1}"
        floats.append(f"WHEN {cond} THEN {_q(name)}")
    floating = "CASE " + " ".join(floats) + " END"
    observed = (f"CASE WHEN {wd} = 4 THEN concat({_fixed_sql(f'date_add({d}, 1)')}, {_q(OBSERVED_SUFFIX)}) "
                f"WHEN {wd} = 0 THEN concat({_fixed_sql(f'date_sub({d}, 1)')}, {_q(OBSERVED_SUFFIX)}) END")
    return f"coalesce({_fixed_sql(d)}, {floating}, {observed})"


def us_holiday_name(d) -> Column:
    """Holiday name for a date, NULL when it is not a holiday.

    Fixed-date holidays on a Saturday are observed the Friday before, on a
    Sunday the Monday after.  Given a column *name*, the rules are one parsed
    SQL expression (one call instead of hundreds of expression-builder calls);
    given a ``Column`` they are composed with the functions API.
    """
    if isinstance(d, str):
        return F.expr(holiday_spark_sql(f"to_date(`{d}`)"))
    wd = F.weekday(d)
    return F.coalesce(_fixed(d), _floating(d),
                      F.when(wd == 4, F.concat(_fixed(F.date_add(d, 1)), F.lit(OBSERVED_SUFFIX)))
                      .when(wd == 0, F.concat(_fixed(F.date_sub(d, 1)), F.lit(OBSERVED_SUFFIX))))


def _fixed(d: Column) -> Column:
    m, dd, y = F.month(d), F.dayofmonth(d), F.year(d)
    expr = None
    for month, day, name, since in FIXED_DATE_HOLIDAYS:
        cond = (m == month) & (dd == day) & (y >= since)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def _floating(d: Column) -> Column:
    m, dd, wd = F.month(d), F.dayofmonth(d), F.weekday(d)
    expr = None
    for month, weekday, nth, name in FLOATING_HOLIDAYS:
        if nth == -1:
            cond = (m == month) & (wd == weekday) & (dd + 7 > F.dayofmonth(F.last_day(d)))
        else:
            cond = (m == month) & (wd == weekday) & (F.floor((dd - 1) / 7) == nth - 1)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def holiday_name_sql(d: str) -> str:
    """The same rules as DuckDB SQL text over a DATE expression (used by the oracle)."""
    def fixed(x):
        parts = [f"WHEN month({x}) = {m} AND day({x}) = {dd} AND year({x}) >= {since} THEN '{n.replace(chr(39), chr(39) * 2)}'"
                 for m, dd, n, since in FIXED_DATE_HOLIDAYS]
        return "CASE " + " ".join(parts) + " END"

    wd = f"(isodow({d}) - 1)"
    floats = []
    for month, weekday, nth, name in FLOATING_HOLIDAYS:
        nm = name.replace("'", "''")
        if nth == -1:
            cond = f"month({d}) = {month} AND {wd} = {weekday} AND day({d}) + 7 > day(last_day({d}))"
        else:
            cond = f"month({d}) = {month} AND {wd} = {weekday} AND (day({d}) - 1) // 7 = {nth - 1}"
        floats.append(f"WHEN {cond} THEN '{nm}'")
    floating = "CASE " + " ".join(floats) + " END"
    plus1 = f"CAST({d} + INTERVAL 1 DAY AS DATE)"
    minus1 = f"CAST({d} - INTERVAL 1 DAY AS DATE)"
    observed = (f"CASE WHEN {wd} = 4 THEN ({fixed(plus1)}) || '{OBSERVED_SUFFIX}' "
                f"WHEN {wd} = 0 THEN ({fixed(minus1)}) || '{OBSERVED_SUFFIX}' END")
    return f"coalesce({fixed(d)}, {floating}, {observed})"
