"""Great-circle distance and a local metric projection in native math."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import EARTH_RADIUS_M


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle metres on a sphere of radius 6,371,000 m."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = F.radians(_c(lat2) - _c(lat1))
    dlng = F.radians(_c(lng2) - _c(lng1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


def aeqd_xy(lat, lng, lat0, lng0) -> tuple[Column, Column]:
    """Spherical azimuthal-equidistant metres (x east, y north) around (lat0, lng0)."""
    phi, lam = F.radians(_c(lat)), F.radians(_c(lng))
    phi0, lam0 = F.radians(_c(lat0)), F.radians(_c(lng0))
    dl = lam - lam0
    cos_c = F.sin(phi0) * F.sin(phi) + F.cos(phi0) * F.cos(phi) * F.cos(dl)
    c = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos_c)))
    k = F.when(c == 0, F.lit(1.0)).otherwise(c / F.sin(c))
    x = F.lit(EARTH_RADIUS_M) * k * F.cos(phi) * F.sin(dl)
    y = F.lit(EARTH_RADIUS_M) * k * (F.cos(phi0) * F.sin(phi) - F.sin(phi0) * F.cos(phi) * F.cos(dl))
    return x, y


def in_box(lat, lng, lat_lo, lat_hi, lng_lo, lng_hi) -> Column:
    """Inclusive latitude/longitude box."""
    return _c(lat).between(lat_lo, lat_hi) & _c(lng).between(lng_lo, lng_hi)
