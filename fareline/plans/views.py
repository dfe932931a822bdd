"""Shared Spark inputs and the SQL text of the same views for the oracle.

Spark side: DataFrame builders over the whole ``events`` table.
Oracle side: CTE text valid in DuckDB, prepended to each oracle query.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import validate as val
from ..session import scratch_path
from ..sources import tables

TRIPS_SQL = """
trips AS (
  WITH base AS (
    SELECT event_id, event_type, ts, value FROM events
    UNION ALL
    SELECT event_id, event_type, ts, value FROM events WHERE event_id % 113 = 0
  )
  SELECT event_id, event_type,
    CASE WHEN event_id % 211 = 0 THEN -value ELSE value END AS fare_amount,
    ts AS pickup_datetime,
    CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE -74.05e0 + ((event_id * 7919) % 3000) / 1e4 END AS pickup_longitude,
    CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE 40.60e0 + ((event_id * 6101) % 3000) / 1e4 END AS pickup_latitude,
    CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN event_id % 307 = 0 THEN -72.85e0
         WHEN event_id % 23 = 0 THEN -73.7781e0 + ((event_id * 31) % 100) / 1e4
         WHEN event_id % 89 = 0 THEN -74.05e0 + ((event_id * 7919) % 3000) / 1e4
         ELSE -74.05e0 + ((event_id * 4243) % 3000) / 1e4 END AS dropoff_longitude,
    CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN event_id % 307 = 0 THEN 41.15e0
         WHEN event_id % 23 = 0 THEN 40.6413e0 + ((event_id * 37) % 100) / 1e4
         WHEN event_id % 89 = 0 THEN 40.60e0 + ((event_id * 6101) % 3000) / 1e4
         ELSE 40.60e0 + ((event_id * 3571) % 3000) / 1e4 END AS dropoff_latitude,
    (event_id * 17) % 9 AS passenger_count
  FROM base
)"""

CLEAN_SQL = """
clean_trips AS (
  SELECT DISTINCT * FROM trips
  WHERE fare_amount BETWEEN 2.5e0 AND 300e0
    AND passenger_count BETWEEN 1 AND 6
    AND pickup_latitude BETWEEN 40.40e0 AND 41.20e0 AND dropoff_latitude BETWEEN 40.40e0 AND 41.20e0
    AND pickup_longitude BETWEEN -74.60e0 AND -72.80e0 AND dropoff_longitude BETWEEN -74.60e0 AND -72.80e0
    AND NOT (pickup_latitude = dropoff_latitude AND pickup_longitude = dropoff_longitude)
)"""

PAIRS_SQL = """
pairs AS (
  SELECT event_id, fare_amount AS actual_fare,
         fare_amount * (75 + (event_id * 13) % 51) / 1e2 AS predicted_fare
  FROM clean_trips
)"""

TWO_SIDES_SQL = """
two_sides AS (
  SELECT CASE WHEN pickup_datetime < TIMESTAMP '2024-01-16 00:00:00' THEN 'expected' ELSE 'actual' END AS side, *
  FROM clean_trips
)"""

# FT-0 in SQL (haversine R = 6371.0088, New York wall clock, 2 km airports).
_HAV = ("(6371.0088e0 * 2 * asin(least(1e0, sqrt(pow(sin((radians({la2}) - radians({la1})) / 2), 2) "
        "+ cos(radians({la1})) * cos(radians({la2})) * pow(sin((radians({lo2}) - radians({lo1})) / 2), 2)))))")


def hav(la1, lo1, la2, lo2) -> str:
    return _HAV.format(la1=la1, lo1=lo1, la2=la2, lo2=lo2)


_NEAR = "CAST(({p} <= 2e0 OR {d} <= 2e0) AS INTEGER)"


def _near(lat, lon):
    return _NEAR.format(p=hav("pickup_latitude", "pickup_longitude", lat, lon),
                        d=hav("dropoff_latitude", "dropoff_longitude", lat, lon))


FEATURES_SQL = f"""
f0 AS (
  SELECT *,
    {hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude')} AS trip_distance_km,
    {hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'pickup_longitude')}
      + {hav('dropoff_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude')} AS manhattan_distance_km,
    (degrees(atan2(sin(radians(dropoff_longitude) - radians(pickup_longitude)) * cos(radians(dropoff_latitude)),
       cos(radians(pickup_latitude)) * sin(radians(dropoff_latitude))
       - sin(radians(pickup_latitude)) * cos(radians(dropoff_latitude)) * cos(radians(dropoff_longitude) - radians(pickup_longitude))))
       + 360e0) % 360e0 AS bearing_deg,
    timezone('America/New_York', timezone('UTC', pickup_datetime)) AS _local
  FROM clean_trips
),
f1 AS (
  SELECT *, CAST(hour(_local) AS INTEGER) AS pickup_hour, CAST(isodow(_local) - 1 AS INTEGER) AS pickup_dow,
    CAST(month(_local) AS INTEGER) AS pickup_month, CAST(year(_local) AS INTEGER) AS pickup_year
  FROM f0 WHERE trip_distance_km <= 100e0
),
f2 AS (
  SELECT *,
    CAST(pickup_dow >= 5 AS INTEGER) AS is_weekend,
    CAST(pickup_hour IN (7, 8, 9, 16, 17, 18, 19) AS INTEGER) AS is_rush_hour,
    CAST(pickup_hour IN (23, 0, 1, 2, 3, 4) AS INTEGER) AS is_late_night,
    sin(2 * pi() * pickup_hour / 24) AS hour_sin, cos(2 * pi() * pickup_hour / 24) AS hour_cos,
    sin(2 * pi() * pickup_dow / 7) AS dow_sin, cos(2 * pi() * pickup_dow / 7) AS dow_cos,
    {_near('40.6413e0', '-73.7781e0')} AS near_jfk,
    {_near('40.7769e0', '-73.8740e0')} AS near_lga,
    {_near('40.6895e0', '-74.1745e0')} AS near_ewr,
    {hav('pickup_latitude', 'pickup_longitude', '40.7580e0', '-73.9855e0')} AS pickup_dist_from_center_km
  FROM f1
),
features AS (
  SELECT * EXCLUDE (_local),
    greatest(near_jfk, near_lga, near_ewr) AS airport_trip,
    trip_distance_km * is_rush_hour AS distance_x_rush_hour,
    trip_distance_km / CASE WHEN passenger_count = 0 THEN 1 ELSE passenger_count END AS distance_per_passenger
  FROM f2
)"""

_ORDER = ("trips", "clean_trips", "pairs", "two_sides", "features")
_TEXT = {"trips": TRIPS_SQL, "clean_trips": CLEAN_SQL, "pairs": PAIRS_SQL,
         "two_sides": TWO_SIDES_SQL, "features": FEATURES_SQL}
_DEPS = {"trips": (), "clean_trips": ("trips",), "pairs": ("clean_trips",),
         "two_sides": ("clean_trips",), "features": ("clean_trips",)}


def with_views(sql: str, *names: str, extra: str = "") -> str:
    """Prefix ``sql`` with the CTEs it needs (dependencies included)."""
    need: set[str] = set()

    def add(n):
        if n not in need:
            need.add(n)
            for d in _DEPS[n]:
                add(d)

    for n in names:
        add(n)
    parts = [_TEXT[n].strip() for n in _ORDER if n in need]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()


# --- Spark inputs ----------------------------------------------------------

_INGESTED: dict = {}


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """The raw trip table, ingested once per session into the shared checkpoint folder.

    The reference starts from a raw trip file; here that file is derived from
    ``events`` (whole table) and written as parquet once, so every query
    scans plain columns (filters and projections pushed into the scan) and
    the written table survives executor loss. Keyed by the source files as
    Spark lists them (any file system) with their sizes and times of writing, and read again
    from the events if these have been written anew or the written table is gone.
    """
    events = tables.read_table(spark, sf, "events")
    state = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    version = events.agg(F.count(F.lit(1)), F.sum(F.pmod(state, F.lit(1 << 31)))).first()
    key = (tuple(sorted(events.inputFiles())), tuple(version), id(spark.sparkContext))
    path = _INGESTED.get(key)
    if path is not None:
        try:
            return spark.read.parquet(path)
        except AnalysisException:       # the scratch folder was removed meanwhile
            pass
    path = scratch_path(spark, "trips-ingest")
    t = tables.trips_from_events(events)
    par = spark.sparkContext.defaultParallelism
    if t.rdd.getNumPartitions() < par:
        t = t.repartition(par)
    t.write.mode("overwrite").parquet(path)
    _INGESTED[key] = path
    return spark.read.parquet(path)


def trips_path(spark: SparkSession, sf: str) -> tuple:
    """(folder, schema) of the written trip table, as a stream's source."""
    t = trips(spark, sf)
    return os.path.dirname(t.inputFiles()[0]), t.schema


def clean_trips(spark: SparkSession, sf: str) -> DataFrame:
    return val.validate_trips(trips(spark, sf), check_size=False)


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return tables.pairs_from_clean(clean_trips(spark, sf))


def two_sides(spark: SparkSession, sf: str) -> DataFrame:
    return tables.two_sides(clean_trips(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return ft.add_engineered_features(clean_trips(spark, sf))
