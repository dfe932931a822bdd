"""Feature building (FT-0 and its parts): one projection chain, no action.

Everything is a Column expression inside whole-stage codegen; the only
filter (distance <= max) is a narrow row filter. The same function is
applied to batch tables and to streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RULES, MANHATTAN_CENTER, TripRules
from ..functions import calendar as cal
from ..functions import geo

PLAT, PLON, DLAT, DLON = "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"

FEATURE_COLUMNS = (
    "trip_distance_km", "manhattan_distance_km", "bearing_deg",
    "pickup_hour", "pickup_dow", "pickup_month", "pickup_year",
    "is_weekend", "is_rush_hour", "is_late_night",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "near_jfk", "near_lga", "near_ewr", "airport_trip",
    "pickup_dist_from_center_km", "distance_x_rush_hour", "distance_per_passenger",
)


def distance_columns() -> dict:
    return {
        "trip_distance_km": geo.haversine_km(PLAT, PLON, DLAT, DLON),
        "manhattan_distance_km": geo.manhattan_km(PLAT, PLON, DLAT, DLON),
        "bearing_deg": geo.bearing_deg(PLAT, PLON, DLAT, DLON),
    }


def airport_flags(rules: TripRules = DEFAULT_RULES) -> dict:
    """GEO-7: near_<airport> = pickup or drop-off within the radius (inclusive)."""
    out = {}
    r = f"CAST({float(rules.airport_radius_km)!r} AS DOUBLE)"
    for name, (lat, lon) in rules.airports:
        pt = (f"CAST({float(lat)!r} AS DOUBLE)", f"CAST({float(lon)!r} AS DOUBLE)")
        p = geo.haversine_sql(f"`{PLAT}`", f"`{PLON}`", *pt)
        d = geo.haversine_sql(f"`{DLAT}`", f"`{DLON}`", *pt)
        out[f"near_{name}"] = F.expr(f"CAST(coalesce({p} <= {r} OR {d} <= {r}, false) AS INT)")
    return out


def add_engineered_features(df: DataFrame, rules: TripRules = DEFAULT_RULES, drop_long: bool = True) -> DataFrame:
    """FT-0: the complete feature table (VAL-19 distance filter included unless ``drop_long`` is off).

    Two projections and one filter: raw-coordinate / clock features first,
    then the columns derived from them (the distance filter sits between).
    """
    base_cols = list(df.columns)
    first = {**distance_columns(), **cal.calendar_columns("pickup_datetime", rules.tz)}
    flags = airport_flags(rules)
    first.update(flags)
    first["pickup_dist_from_center_km"] = geo.distance_to_point(PLAT, PLON, MANHATTAN_CENTER)
    df = df.withColumns(first)
    if drop_long:
        df = df.where(F.col("trip_distance_km") <= rules.max_trip_km)
    second = {**cal.flag_columns(), **cal.cyclic_columns()}
    second["airport_trip"] = F.expr(f"CAST(greatest({', '.join(flags)}) AS INT)")
    df = df.withColumns(second)
    return df.withColumns({
        "distance_x_rush_hour": F.expr("trip_distance_km * is_rush_hour"),
        "distance_per_passenger": F.expr(
            "trip_distance_km / CASE WHEN passenger_count = 0 THEN 1 ELSE passenger_count END"),
    }).select(*base_cols, *FEATURE_COLUMNS)


def add_log_target(df: DataFrame, target: str = "fare_amount") -> DataFrame:
    """INT-2: log1p of fare and distance (inverse is ``expm1``)."""
    return df.withColumns({
        f"log_{target}": F.log1p(F.col(target)),
        "log_trip_distance_km": F.log1p(F.col("trip_distance_km")),
    })


def fare_per_km(fare: str = "fare_amount", dist: str = "trip_distance_km"):
    """INT-3: fare / km, NULL when the distance is 0 (ANSI-safe)."""
    return F.try_divide(F.col(fare), F.col(dist))


def narrow_types(df: DataFrame, skip=("fare_amount", "pickup_datetime")) -> DataFrame:
    """TYP-1: double -> float and integral -> smallest int for storage.

    Integer ranges come from one min/max aggregate over all columns (one
    job); floats are cast unconditionally, as the reference does.
    """
    types = dict(df.dtypes)
    ints = [c for c, t in types.items() if t in ("bigint", "int", "smallint") and c not in skip]
    bounds = {}
    if ints:
        row = df.agg(*[F.min(c).alias(f"{c}__min") for c in ints],
                     *[F.max(c).alias(f"{c}__max") for c in ints]).first()
        bounds = {c: (row[f"{c}__min"], row[f"{c}__max"]) for c in ints}
    cols = []
    for c in df.columns:
        t = types[c]
        if c in skip:
            cols.append(F.col(c))
        elif t == "double":
            cols.append(F.col(c).cast("float").alias(c))
        elif c in bounds and bounds[c][0] is not None:
            lo, hi = bounds[c]
            target = ("tinyint" if -128 <= lo and hi <= 127 else
                      "smallint" if -32768 <= lo and hi <= 32767 else
                      "int" if -2**31 <= lo and hi < 2**31 else "bigint")
            cols.append(F.col(c).cast(target).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
