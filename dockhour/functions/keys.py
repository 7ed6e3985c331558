"""Key normalisation and lenient parsing."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import ALL_CITIES_BUILDER, MISSING_CITY, MISSING_STATION

# A number as a lenient text parser accepts it: sign, digits with an optional
# point, optional exponent.  ``1d``, ``0x1A``, ``1_0``, ``inf`` and ``nan`` are
# not numbers here even though a plain cast may accept some of them.
NUMERIC_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_STRIP = r"^\s+|\s+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_station_id(c) -> Column:
    """``31631``, ``31631.0``, ``' 31631.0'`` -> ``'31631'``; other text kept; null -> sentinel."""
    raw = F.regexp_replace(_col(c).cast("string"), _STRIP, "")
    num = F.when(raw.rlike(NUMERIC_TEXT), raw.try_cast("double"))
    int_like = num.isNotNull() & (F.abs(num) < F.lit(float("inf"))) & ((num % 1) == 0)
    as_int = num.try_cast("bigint").cast("string")
    out = F.when(int_like & as_int.isNotNull(), as_int).otherwise(raw)
    return F.coalesce(out, F.lit(MISSING_STATION))


def city_key(df_columns, city_col: str = "city", absent: str = ALL_CITIES_BUILDER) -> Column:
    """Null city -> sentinel; a missing column -> one constant key."""
    if city_col in df_columns:
        return F.coalesce(F.col(city_col).cast("string"), F.lit(MISSING_CITY))
    return F.lit(absent)


def floor_hour(ts) -> Column:
    """Hour floor of a ``timestamp_ntz`` without any time-zone round trip."""
    t = _col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def _as_ntz(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, T.TimestampNTZType):
        return F.col(c)
    if isinstance(dt, T.TimestampType):
        return F.col(c).cast("timestamp_ntz")
    if isinstance(dt, T.DateType):
        return F.col(c).cast("timestamp_ntz")
    return F.try_to_timestamp(F.col(c).cast("string")).cast("timestamp_ntz")


def resolve_hour(df: DataFrame, precedence=("hour_ts", "started_at")) -> Column:
    """Pick the time column by *presence* (once, not per row) and floor it to the hour.

    ``precedence`` may end with ``("date", "hour")`` meaning date + hour offset.
    """
    for p in precedence:
        if isinstance(p, tuple):
            d, h = p
            if d in df.columns and h in df.columns:
                base = _as_ntz(df, d)
                hrs = F.coalesce(F.col(h).try_cast("double"), F.lit(0.0))
                return floor_hour(base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                            hrs * 3600))
            continue
        if p in df.columns:
            return floor_hour(_as_ntz(df, p))
    raise ValueError(f"Need one of {list(precedence)} to define the target hour.")


def numeric_coerce(c) -> Column:
    """Text -> double, failures -> NULL (never NaN)."""
    v = _col(c)
    raw = F.regexp_replace(v.cast("string"), _STRIP, "")
    return nan_to_null(F.when(raw.rlike(NUMERIC_TEXT), raw.try_cast("double")))


def nan_to_null(c) -> Column:
    v = _col(c)
    return F.when(~F.isnan(v), v)


def conform_schema(df: DataFrame, columns, types: dict | None = None) -> DataFrame:
    """Reindex to a fixed column list; absent columns become typed NULLs."""
    types = types or {}
    out = []
    for c in columns:
        if c in df.columns:
            out.append(F.col(c))
        else:
            out.append(F.lit(None).cast(types.get(c, "double")).alias(c))
    return df.select(*out)
