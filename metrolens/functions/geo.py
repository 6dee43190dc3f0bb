"""Great-circle distance on a sphere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType

from metrolens.functions._util import as_col

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km between two points given in degrees.

    Native expression (no Python worker). ``a`` is clamped to 1 so that
    rounding never hands ``sqrt`` a negative. NULL in gives NULL out; NaN or an
    infinity in gives NaN out.
    """
    p1 = F.radians(as_col(lat1))
    p2 = F.radians(as_col(lat2))
    half_dlat = (p2 - p1) / 2.0
    half_dlon = (F.radians(as_col(lon2)) - F.radians(as_col(lon1))) / 2.0
    s_lat = F.sin(half_dlat)
    s_lon = F.sin(half_dlon)
    raw = s_lat * s_lat + F.cos(p1) * F.cos(p2) * (s_lon * s_lon)
    # Not least(): it skips NULLs and would turn a NULL coordinate into a distance.
    # NaN counts as the largest number in comparisons, so it needs its own arm.
    a = F.when((raw > 1.0) & ~F.isnan(raw), F.lit(1.0)).otherwise(raw)
    return F.lit(float(radius_km)) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


@arrow_udf(DoubleType())
def _haversine_batch(lat1: pa.Array, lon1: pa.Array, lat2: pa.Array, lon2: pa.Array) -> pa.Array:
    # Arrow arrays keep NULL apart from NaN, which pandas does not.
    null = np.zeros(len(lat1), bool)
    radians = []
    for given in (lat1, lon1, lat2, lon2):
        null |= given.is_null().to_numpy(zero_copy_only=False)
        radians.append(np.radians(given.fill_null(0.0).to_numpy(zero_copy_only=False).astype("float64")))
    p1, l1, p2, l2 = radians
    with np.errstate(invalid="ignore"):
        s_lat, s_lon = np.sin((p2 - p1) / 2.0), np.sin((l2 - l1) / 2.0)
        a = np.minimum(1.0, s_lat * s_lat + np.cos(p1) * np.cos(p2) * (s_lon * s_lon))
        km = EARTH_RADIUS_KM * (2.0 * np.arctan2(np.sqrt(a), np.sqrt(1.0 - a)))
    return pa.array(km, pa.float64(), mask=null)


def haversine_km_udf(lat1, lon1, lat2, lon2) -> Column:
    """Arrow-batched twin of :func:`haversine_km` (the reference computed this in a row UDF)."""
    return _haversine_batch(as_col(lat1), as_col(lon1), as_col(lat2), as_col(lon2))
