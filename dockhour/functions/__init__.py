"""Column expressions: everything here returns a ``Column`` and stays JVM-side."""
from .keys import (normalize_station_id, city_key, resolve_hour, floor_hour, numeric_coerce,
                   conform_schema, nan_to_null)
from .time import (time_parts, cyclical_time, format_ts, format_date, hour_in, calendar_fields)
from .holidays import us_holiday_name
from .geo import haversine_m, aeqd_xy, in_box

__all__ = [
    "normalize_station_id", "city_key", "resolve_hour", "floor_hour", "numeric_coerce",
    "conform_schema", "nan_to_null", "time_parts", "cyclical_time", "format_ts", "format_date",
    "hour_in", "calendar_fields", "us_holiday_name", "haversine_m", "aeqd_xy", "in_box",
]
