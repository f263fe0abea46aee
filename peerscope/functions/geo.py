"""Geographic and closeness column expressions (GEO1, MTH1, MTH2)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km used by the reference's haversine.
EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp_unit(x: Column) -> Column:
    """min(x, 1) that keeps NULL as NULL (``least`` would skip the NULL)."""
    return F.when(x > 1.0, F.lit(1.0)).otherwise(x)


def haversine_km(lat_a, lon_a, lat_b, lon_b) -> Column:
    """Great-circle distance in km; NULL when any coordinate is NULL."""
    pa, pb = F.radians(_col(lat_a)), F.radians(_col(lat_b))
    dlat = pb - pa
    dlon = F.radians(_col(lon_b)) - F.radians(_col(lon_a))
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(pa) * F.cos(pb) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * (2 * F.asin(F.sqrt(clamp_unit(h))))


def arc_km_from_haversine(h: Column) -> Column:
    return F.lit(EARTH_RADIUS_KM) * (2 * F.asin(F.sqrt(clamp_unit(h))))


def closeness_from_gap(gap: Column, tolerance: float) -> Column:
    """1 - min(gap / tolerance, 1), NULL-preserving (gap >= 0)."""
    return F.lit(1.0) - clamp_unit(gap / F.lit(float(tolerance)))


def bounded_closeness(reference, observed, tolerance: float) -> Column:
    """max(1 - min(|a - b| / tol, 1), 0); NULL when either side is NULL."""
    return closeness_from_gap(F.abs(_col(reference) - _col(observed)), tolerance)
