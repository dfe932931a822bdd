"""Scans of the input tables and the derived trip views.

The test tables carry no coordinates, so a trip table is derived from
``events`` with integer arithmetic (the derivation plants every defect the
validation rules look for: duplicates, negative fares, null island,
missing drop-offs, drop-offs at JFK, zero-length trips, trips of about 100 km,
bad passenger counts). It is a plain projection + union of the whole table: no sampling,
and Catalyst prunes the unused ``events`` columns at the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# The derivation as SQL text: one projection sent to the JVM in one call.
_TRIP_EXPRS = (
    "event_id",
    "event_type",
    "CASE WHEN event_id % 211 = 0 THEN -value ELSE value END AS fare_amount",
    "ts AS pickup_datetime",
    "CASE WHEN event_id % 97 = 0 THEN 0.0D ELSE -74.05D + ((event_id * 7919) % 3000) / 1e4D END AS pickup_longitude",
    "CASE WHEN event_id % 97 = 0 THEN 0.0D ELSE 40.60D + ((event_id * 6101) % 3000) / 1e4D END AS pickup_latitude",
    "CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE) "
    "WHEN event_id % 307 = 0 THEN -72.85D "
    "WHEN event_id % 23 = 0 THEN -73.7781D + ((event_id * 31) % 100) / 1e4D "
    "WHEN event_id % 89 = 0 THEN -74.05D + ((event_id * 7919) % 3000) / 1e4D "
    "ELSE -74.05D + ((event_id * 4243) % 3000) / 1e4D END AS dropoff_longitude",
    "CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE) "
    "WHEN event_id % 307 = 0 THEN 41.15D "
    "WHEN event_id % 23 = 0 THEN 40.6413D + ((event_id * 37) % 100) / 1e4D "
    "WHEN event_id % 89 = 0 THEN 40.60D + ((event_id * 6101) % 3000) / 1e4D "
    "ELSE 40.60D + ((event_id * 3571) % 3000) / 1e4D END AS dropoff_latitude",
    "(event_id * 17) % 9 AS passenger_count",
)


def trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trips (with planted defects) derived from the events table."""
    base = events.select("event_id", "event_type", "ts", "value")
    dup = base.where("event_id % 113 = 0")
    return base.unionByName(dup).selectExpr(*_TRIP_EXPRS)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_table(spark, sf_dir, "events"))


def pair_columns() -> dict:
    """(actual, predicted) for a clean trip: a deterministic 75%..125% multiplier."""
    return {"actual_fare": F.col("fare_amount"),
            "predicted_fare": F.col("fare_amount") * (75 + (F.col("event_id") * 13) % 51) / F.lit(1e2)}


def pairs_from_clean(clean: DataFrame) -> DataFrame:
    """(event_id, actual_fare, predicted_fare) pairs of the clean trips."""
    return clean.select("event_id", *[c.alias(k) for k, c in pair_columns().items()])


SPLIT_TS = "2024-01-16 00:00:00"


def two_sides(clean: DataFrame, split_ts: str = SPLIT_TS) -> DataFrame:
    """Label trips before ``split_ts`` 'expected' and the rest 'actual'."""
    side = F.when(F.col("pickup_datetime") < F.lit(split_ts).cast("timestamp_ntz"), "expected").otherwise("actual")
    return clean.select(side.alias("side"), *clean.columns)
