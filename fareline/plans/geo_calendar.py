"""Queries for the geo / calendar / interaction scalar functions and FT-0."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_RULES
from ..functions import calendar as cal
from ..functions import geo
from ..operators import features as ft
from . import register
from . import views as v
from .common import rnd

P = ("pickup_latitude", "pickup_longitude")
D = ("dropoff_latitude", "dropoff_longitude")


@register("geo_haversine", v.with_views(f"""
SELECT event_id, round({v.hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude')}, 6) AS trip_distance_km,
       round({v.hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude')} * 0.621371e0, 6) AS trip_distance_mi
FROM clean_trips""", "clean_trips"))
def _geo_hav(spark, sf):
    """GEO-1/GEO-4: haversine km (R = 6371.0088) and miles per trip."""
    c = v.clean_trips(spark, sf)
    d = geo.haversine_km(*P, *D)
    return c.select("event_id", rnd(d).alias("trip_distance_km"), rnd(d * 0.621371).alias("trip_distance_mi"))


@register("geo_haversine_lonlat", v.with_views("""
SELECT event_id, round(6371e0 * 2 * asin(least(1e0, sqrt(pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)
  + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude)) * pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2)))), 6) AS distance_km
FROM clean_trips""", "clean_trips"))
def _geo_hav_nb(spark, sf):
    """GEO-2: notebook variant, (lon, lat) order and R = 6371.0."""
    c = v.clean_trips(spark, sf)
    d = geo.haversine_km_lonlat(lon1="pickup_longitude", lat1="pickup_latitude",
                                lon2="dropoff_longitude", lat2="dropoff_latitude")
    return c.select("event_id", rnd(d).alias("distance_km"))


@register("geo_manhattan_bearing", v.with_views("""
SELECT event_id, round(manhattan_distance_km, 6) AS manhattan_distance_km, round(bearing_deg, 6) AS bearing_deg,
       round(pickup_dist_from_center_km, 6) AS pickup_dist_from_center_km
FROM features""", "features"))
def _geo_manhattan(spark, sf):
    """GEO-5/GEO-6/GEO-8: Manhattan distance, bearing, distance from the city centre."""
    f = v.features(spark, sf)
    return f.select("event_id", rnd("manhattan_distance_km").alias("manhattan_distance_km"),
                    rnd("bearing_deg").alias("bearing_deg"),
                    rnd("pickup_dist_from_center_km").alias("pickup_dist_from_center_km"))


@register("geo_airport_flags", v.with_views("""
SELECT near_jfk, near_lga, near_ewr, airport_trip, count(*) AS n_trips FROM features GROUP BY 1, 2, 3, 4""",
                                            "features"))
def _geo_airports(spark, sf):
    """GEO-7: airport proximity flags (2 km, either end)."""
    f = v.features(spark, sf)
    return f.groupBy("near_jfk", "near_lga", "near_ewr", "airport_trip").agg(F.count(F.lit(1)).alias("n_trips"))


AIRPORTS_SQL = "(VALUES ('jfk', 40.6413e0, -73.7781e0), ('lga', 40.7769e0, -73.8740e0), ('ewr', 40.6895e0, -74.1745e0)) AS a(airport, lat, lon)"


@register("geo_airport_range_join", v.with_views(f"""
SELECT a.airport, count(*) AS n_trips
FROM clean_trips t CROSS JOIN {AIRPORTS_SQL}
WHERE {v.hav('t.pickup_latitude', 't.pickup_longitude', 'a.lat', 'a.lon')} <= 2e0
   OR {v.hav('t.dropoff_latitude', 't.dropoff_longitude', 'a.lat', 'a.lon')} <= 2e0
GROUP BY a.airport""", "clean_trips"))
def _geo_range_join(spark, sf):
    """JN-2: trips within 2 km of any point of a points table (non-equi join).

    Grid-bucketed equi-join on cell keys + exact distance test (see
    ``airports_within``); works the same for a points table of any size.
    """
    c = v.clean_trips(spark, sf)
    pts = spark.createDataFrame([(n, float(p[0]), float(p[1])) for n, p in DEFAULT_RULES.airports],
                                "airport string, lat double, lon double")
    return airports_within(c, pts, DEFAULT_RULES.airport_radius_km).groupBy("airport").agg(
        F.count(F.lit(1)).alias("n_trips"))


def airports_within(trips, points, radius_km: float):
    """Range join: (trip, point) pairs where either trip end is within ``radius_km``.

    Grid-bucketed equi-join, exact: the plane is cut into cells at least
    ``radius_km`` wide; each point is copied into every cell its radius box
    touches, each trip end looks up only its own cell, and the exact
    haversine test runs on those candidates. The join is a hash join on the
    cell key (broadcast when the points side is small, shuffled otherwise),
    so neither side is compared with all rows of the other.
    """
    import math

    from ..config import EARTH_RADIUS_KM

    dlat = math.degrees(radius_km / EARTH_RADIUS_KM) * 1.001
    bounds = points.agg(F.max(F.abs("lat")).alias("m")).first()
    max_lat = min(89.0, (bounds["m"] or 0.0) + dlat)
    dlon = dlat / math.cos(math.radians(max_lat))
    cells = points.select(
        "airport", F.col("lat").alias("_plat"), F.col("lon").alias("_plon"),
        F.explode(F.sequence(F.floor((F.col("lat") - dlat) / dlat), F.floor((F.col("lat") + dlat) / dlat))).alias("_cy"),
    ).select("*", F.explode(F.sequence(F.floor((F.col("_plon") - dlon) / dlon),
                                       F.floor((F.col("_plon") + dlon) / dlon))).alias("_cx"))

    # each row once per airport, whichever of its ends is near; repeated rows stay repeated
    ends = F.array(F.struct(F.lit(0).alias("_end"), F.col("pickup_latitude").alias("_lat"), F.col("pickup_longitude").alias("_lon")),
                   F.struct(F.lit(1).alias("_end"), F.col("dropoff_latitude").alias("_lat"), F.col("dropoff_longitude").alias("_lon")))
    near_pickup = geo.haversine_km(F.col("pickup_latitude"), F.col("pickup_longitude"), F.col("_plat"), F.col("_plon")) <= radius_km
    t = (trips.select("*", F.inline(ends)).withColumn("_cy", F.floor(F.col("_lat") / dlat)).withColumn("_cx", F.floor(F.col("_lon") / dlon)))
    near = t.join(cells, ["_cy", "_cx"]).where(geo.haversine_km(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon")) <= radius_km)
    # an airport near both ends comes from the pickup side only
    once = near.where((F.col("_end") == 0) | ~F.coalesce(near_pickup, F.lit(False)))
    return once.select(*trips.columns, "airport")


@register("cal_features", v.with_views("""
SELECT event_id, pickup_hour, pickup_dow, pickup_month, pickup_year, is_weekend, is_rush_hour, is_late_night,
  round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos, round(dow_sin, 6) AS dow_sin, round(dow_cos, 6) AS dow_cos
FROM features""", "features"))
def _cal(spark, sf):
    """CAL-1/3/4: New York wall-clock calendar columns, flags and cyclic encodings."""
    f = v.features(spark, sf)
    return f.select("event_id", "pickup_hour", "pickup_dow", "pickup_month", "pickup_year", "is_weekend",
                    "is_rush_hour", "is_late_night",
                    *[rnd(c).alias(c) for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")])


@register("cal_features_utc", v.with_views("""
SELECT event_id, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS pickup_dow,
  CAST(month(pickup_datetime) AS INTEGER) AS pickup_month, CAST(year(pickup_datetime) AS INTEGER) AS pickup_year
FROM clean_trips""", "clean_trips"))
def _cal_utc(spark, sf):
    """CAL-2: the notebook variant on the UTC clock (no zone conversion)."""
    c = v.clean_trips(spark, sf)
    return c.select("event_id", *[e.alias(k) for k, e in cal.calendar_columns("pickup_datetime", "UTC").items()])


@register("int_features", v.with_views("""
SELECT event_id, round(distance_x_rush_hour, 6) AS distance_x_rush_hour, round(distance_per_passenger, 6) AS distance_per_passenger,
  round(ln(1 + fare_amount), 6) AS log_fare_amount, round(ln(1 + trip_distance_km), 6) AS log_trip_distance_km,
  round(exp(ln(1 + fare_amount)) - 1, 6) AS fare_roundtrip,
  round(CASE WHEN trip_distance_km = 0 THEN NULL ELSE fare_amount / trip_distance_km END, 6) AS fare_per_km
FROM features""", "features"))
def _int(spark, sf):
    """INT-1/2/3: interactions, log1p / expm1, fare per km (NULL at zero distance)."""
    f = ft.add_log_target(v.features(spark, sf))
    return f.select("event_id", rnd("distance_x_rush_hour").alias("distance_x_rush_hour"),
                    rnd("distance_per_passenger").alias("distance_per_passenger"),
                    rnd("log_fare_amount").alias("log_fare_amount"),
                    rnd("log_trip_distance_km").alias("log_trip_distance_km"),
                    rnd(F.expm1("log_fare_amount")).alias("fare_roundtrip"),
                    rnd(ft.fare_per_km()).alias("fare_per_km"))


FT_DOUBLES = ("trip_distance_km", "manhattan_distance_km", "bearing_deg", "hour_sin", "hour_cos", "dow_sin",
              "dow_cos", "pickup_dist_from_center_km", "distance_x_rush_hour", "distance_per_passenger")
FT_INTS = ("pickup_hour", "pickup_dow", "pickup_month", "pickup_year", "is_weekend", "is_rush_hour",
           "is_late_night", "near_jfk", "near_lga", "near_ewr", "airport_trip")


@register("ft_features", v.with_views(f"""
SELECT event_id, round(fare_amount, 6) AS fare_amount, passenger_count, {', '.join(FT_INTS)},
  {', '.join(f'round({c}, 6) AS {c}' for c in FT_DOUBLES)}
FROM features""", "features"))
def _ft(spark, sf):
    """FT-0: the complete feature table (21 derived columns, > 100 km dropped)."""
    f = v.features(spark, sf)
    return f.select("event_id", rnd("fare_amount").alias("fare_amount"), "passenger_count", *FT_INTS,
                    *[rnd(c).alias(c) for c in FT_DOUBLES])


@register("typ_narrow", v.with_views("SELECT event_id, fare_amount, pickup_datetime, " + ", ".join(
    f"CAST({c} AS {t}) AS {c}" for t, cs in (
        ("FLOAT", ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")),
        ("TINYINT", ("passenger_count", "pickup_hour", "pickup_dow", "pickup_month", "is_weekend", "is_rush_hour", "near_jfk")),
        ("SMALLINT", ("pickup_year",))) for c in cs) + " FROM features", "features"))
def _typ(spark, sf):
    """TYP-1: storage narrowing of the feature table (float / smallest int)."""
    return ft.narrow_types(v.features(spark, sf), skip=("event_id", "fare_amount", "pickup_datetime")).select(
        "event_id", "fare_amount", "pickup_datetime", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
        "passenger_count", "pickup_hour", "pickup_dow", "pickup_month", "is_weekend", "is_rush_hour", "near_jfk", "pickup_year")
