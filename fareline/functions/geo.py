"""Geographic scalar functions as Column expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EARTH_RADIUS_KM


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def _sql_arg(x) -> str | None:
    """SQL text of a column name or number; None for a Column object."""
    if isinstance(x, Column):
        return None
    if isinstance(x, str):
        return f"`{x}`"
    return f"CAST({float(x)!r} AS DOUBLE)"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = EARTH_RADIUS_KM) -> str:
    """SQL text of the haversine distance (arguments are SQL expressions)."""
    return (f"(CAST({float(radius)!r} AS DOUBLE) * 2 * asin(least(1.0D, sqrt("
            f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))")


def haversine_km(lat1, lon1, lat2, lon2, *, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km.

    ``R * 2 * asin(sqrt(sin^2(dphi/2) + cos(phi1) cos(phi2) sin^2(dlambda/2)))``;
    the root is clamped to 1 so rounding can never push asin out of range.
    Arguments may be column names, Columns or numbers (fixed points). With
    names / numbers the expression is sent as one SQL text (one round trip
    to the JVM instead of dozens of Column calls).
    """
    args = [_sql_arg(a) for a in (lat1, lon1, lat2, lon2)]
    if all(a is not None for a in args):
        return F.expr(haversine_sql(*args, radius=radius))
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlam = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(radius) * 2 * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def haversine_km_lonlat(*, lon1, lat1, lon2, lat2, radius: float = 6371.0) -> Column:
    """Notebook variant: (lon, lat) argument order and R = 6371.0."""
    return haversine_km(lat1, lon1, lat2, lon2, radius=radius)


def distance_to_point(lat, lon, point: tuple[float, float]) -> Column:
    return haversine_km(lat, lon, point[0], point[1])


def manhattan_km(lat1, lon1, lat2, lon2) -> Column:
    """Latitude leg at the pickup longitude + longitude leg at the drop-off latitude."""
    return haversine_km(lat1, lon1, lat2, lon1) + haversine_km(lat2, lon1, lat2, lon2)


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing in degrees, [0, 360)."""
    args = [_sql_arg(a) for a in (lat1, lon1, lat2, lon2)]
    if all(a is not None for a in args):
        la1, lo1, la2, lo2 = args
        dl = f"(radians({lo2}) - radians({lo1}))"
        x = f"sin({dl}) * cos(radians({la2}))"
        y = f"cos(radians({la1})) * sin(radians({la2})) - sin(radians({la1})) * cos(radians({la2})) * cos({dl})"
        return F.expr(f"pmod(degrees(atan2({x}, {y})) + 360.0D, 360.0D)")
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlam = F.radians(_c(lon2)) - F.radians(_c(lon1))
    x = F.sin(dlam) * F.cos(p2)
    y = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dlam)
    return F.pmod(F.degrees(F.atan2(x, y)) + 360.0, F.lit(360.0))
