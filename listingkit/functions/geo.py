"""Geodesy as column math: haversine distance and the EPSG:5880 projection.

EPSG:5880 is the American polyconic projection on GRS80 (latitude of origin
0, central meridian -54, false easting 5 000 000, false northing 10 000 000).
Forward and inverse follow the ellipsoidal formulas in Snyder, "Map
Projections - A Working Manual" (USGS PP 1395), chapter 18; the inverse is
Newton's method on latitude: ``project_inverse`` is a column expression
(``F.aggregate`` over a fixed number of steps, evaluated interpreted);
``with_inverse`` is the DataFrame form that keeps every step in generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingkit import constants as K

ColumnOrName = Column | str

A = K.GRS80_A
_F = 1.0 / K.GRS80_INV_F
E2 = 2 * _F - _F * _F
E4, E6 = E2 * E2, E2 * E2 * E2
# meridian-distance series coefficients
M1 = 1 - E2 / 4 - 3 * E4 / 64 - 5 * E6 / 256
M2 = 3 * E2 / 8 + 3 * E4 / 32 + 45 * E6 / 1024
M3 = 15 * E4 / 256 + 45 * E6 / 1024
M4 = 35 * E6 / 3072
LON0 = math.radians(K.POLYCONIC_LON0)
X0, Y0 = K.POLYCONIC_X0, K.POLYCONIC_Y0
NEWTON_STEPS = 6


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine(lat1: ColumnOrName, lon1: ColumnOrName,
              lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """Great-circle distance in metres (sphere of radius 6 371 000 m)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * K.EARTH_RADIUS_M) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def _meridian(phi: Column) -> Column:
    """Meridian distance M(phi) / a."""
    return (F.lit(M1) * phi - F.lit(M2) * F.sin(2 * phi)
            + F.lit(M3) * F.sin(4 * phi) - F.lit(M4) * F.sin(6 * phi))


def _meridian_prime(phi: Column) -> Column:
    """d(M/a)/d(phi)."""
    return (F.lit(M1) - F.lit(2 * M2) * F.cos(2 * phi)
            + F.lit(4 * M3) * F.cos(4 * phi) - F.lit(6 * M4) * F.cos(6 * phi))


def project_forward(lon: ColumnOrName, lat: ColumnOrName) -> tuple[Column, Column]:
    """Degrees (EPSG:4326) -> metres (EPSG:5880) as (x, y) columns."""
    phi = F.radians(_c(lat))
    dlam = F.radians(_c(lon)) - F.lit(LON0)
    sin_phi = F.sin(phi)
    n = F.lit(A) / F.sqrt(1 - F.lit(E2) * sin_phi * sin_phi)
    e = dlam * sin_phi
    ncot = n / F.tan(phi)
    on_equator = phi == 0
    x = F.when(on_equator, F.lit(A) * dlam).otherwise(ncot * F.sin(e)) + F.lit(X0)
    y = (F.when(on_equator, F.lit(0.0))
         .otherwise(F.lit(A) * _meridian(phi) + ncot * (1 - F.cos(e))) + F.lit(Y0))
    return x, y


def _newton(phi: Column, a_: Column, b_: Column) -> Column:
    """One Newton step of the latitude."""
    sin_phi = F.sin(phi)
    c = F.sqrt(1 - F.lit(E2) * sin_phi * sin_phi) * F.tan(phi)
    mn = _meridian(phi)
    mp = _meridian_prime(phi)
    num = a_ * (c * mn + 1) - mn - (mn * mn + b_) * c / 2
    den = (F.lit(E2) * F.sin(2 * phi) * (mn * mn + b_ - 2 * a_ * mn) / (4 * c)
           + (a_ - mn) * (c * mp - 2 / F.sin(2 * phi)) - mp)
    return phi - num / den


def with_inverse(df: DataFrame, x: str, y: str, lon_out: str = "longitude",
                 lat_out: str = "latitude") -> DataFrame:
    """Metres (EPSG:5880) -> degrees (EPSG:4326), as a chain of projections: the
    Newton terms and each step become columns, so the whole computation is
    code-generated and no expression tree blows up.  Helper columns are dropped."""
    xx, yy = F.col(x) - F.lit(X0), F.col(y) - F.lit(Y0)
    out = df.withColumns({"_inv_xx": xx, "_inv_yy": yy})
    out = out.withColumns({"_inv_a": F.col("_inv_yy") / F.lit(A)})
    out = out.withColumns({
        "_inv_b": (F.col("_inv_xx") * F.col("_inv_xx")) / F.lit(A * A)
        + F.col("_inv_a") * F.col("_inv_a"),
        "_inv_phi": F.col("_inv_a")})
    for _ in range(NEWTON_STEPS):
        out = out.withColumn("_inv_phi", _newton(F.col("_inv_phi"), F.col("_inv_a"), F.col("_inv_b")))
    phi = F.col("_inv_phi")
    on_equator = F.col("_inv_yy") == 0
    c_fin = F.sqrt(1 - F.lit(E2) * F.sin(phi) * F.sin(phi)) * F.tan(phi)
    lam = F.when(on_equator, F.col("_inv_xx") / F.lit(A)).otherwise(
        F.asin(F.col("_inv_xx") * c_fin / F.lit(A)) / F.sin(phi)) + F.lit(LON0)
    lat = F.when(on_equator, F.lit(0.0)).otherwise(F.degrees(phi))
    out = out.withColumns({lon_out: F.degrees(lam), lat_out: lat})
    return out.drop("_inv_xx", "_inv_yy", "_inv_a", "_inv_b", "_inv_phi")
