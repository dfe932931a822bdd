"""Queries for the validation rules (VAL-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import quantiles as qt
from ..operators import validate as val
from . import register
from . import views as v
from .common import rnd

CLEAN_COLS = ("event_id, event_type, fare_amount, pickup_datetime, pickup_longitude, pickup_latitude, "
              "dropoff_longitude, dropoff_latitude, passenger_count")


def _val_clean(spark, sf):
    """VAL-1..VAL-10: the whole validation, with the size check, in order."""
    return val.validate_trips(v.trips(spark, sf))


register("val_clean", v.with_views(f"SELECT {CLEAN_COLS} FROM clean_trips", "clean_trips"))(_val_clean)


@register("val_required_nulls", v.with_views("""
SELECT CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count(*) FILTER (WHERE fare_amount IS NULL OR pickup_datetime IS NULL OR pickup_longitude IS NULL
            OR pickup_latitude IS NULL OR dropoff_longitude IS NULL OR dropoff_latitude IS NULL
            OR passenger_count IS NULL) AS BIGINT) AS rows_with_null
FROM trips""", "trips"))
def _val_nulls(spark, sf):
    """VAL-4: rows dropped for a missing required value."""
    t = v.trips(spark, sf)
    any_null = F.lit(False)
    for c in val.REQUIRED_COLUMNS:
        any_null = any_null | F.col(c).isNull()
    return t.agg(F.count(F.lit(1)).alias("rows_in"),
                 F.count_if(any_null).alias("rows_with_null"))


@register("val_reject_reasons", v.with_views("""
, tagged AS (
  SELECT *, CASE
    WHEN fare_amount IS NULL OR pickup_datetime IS NULL OR pickup_longitude IS NULL OR pickup_latitude IS NULL
      OR dropoff_longitude IS NULL OR dropoff_latitude IS NULL OR passenger_count IS NULL THEN 'null_required'
    WHEN NOT (fare_amount BETWEEN 2.5e0 AND 300e0) THEN 'fare_range'
    WHEN NOT (passenger_count BETWEEN 1 AND 6) THEN 'passenger_range'
    WHEN NOT (pickup_latitude BETWEEN 40.40e0 AND 41.20e0 AND dropoff_latitude BETWEEN 40.40e0 AND 41.20e0
      AND pickup_longitude BETWEEN -74.60e0 AND -72.80e0 AND dropoff_longitude BETWEEN -74.60e0 AND -72.80e0) THEN 'outside_box'
    WHEN pickup_latitude = dropoff_latitude AND pickup_longitude = dropoff_longitude THEN 'same_point'
    ELSE 'kept' END AS reject_reason
  FROM trips
), per AS (
  SELECT reject_reason, count(*) AS total, count(DISTINCT (event_id, event_type, fare_amount, pickup_datetime,
    pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, passenger_count)) AS dist
  FROM tagged GROUP BY reject_reason
)
SELECT reject_reason, CAST(CASE WHEN reject_reason = 'kept' THEN dist ELSE total END AS BIGINT) AS n_rows FROM per
UNION ALL
SELECT 'duplicate' AS reject_reason, CAST(total - dist AS BIGINT) AS n_rows FROM per WHERE reject_reason = 'kept'
""", "trips"))
def _val_reasons(spark, sf):
    """VAL-11: first failing rule per row, one pass."""
    return val.reject_reasons(v.trips(spark, sf))


@register("val_clean_summary", v.with_views("""
SELECT count(*) AS n_rows, round(avg(fare_amount), 6) AS fare_mean, round(quantile_cont(fare_amount, 0.5), 6) AS fare_median
FROM clean_trips""", "clean_trips"))
def _val_summary(spark, sf):
    """VAL-11 log line: rows, mean and exact median fare after validation."""
    c = v.clean_trips(spark, sf)
    med = qt.quantile_values(c, ["fare_amount"], [0.5])[((), "fare_amount", 0.5)]
    return c.agg(F.count(F.lit(1)).alias("n_rows"), rnd(F.avg("fare_amount")).alias("fare_mean"),
                 rnd(F.lit(med)).alias("fare_median"))


@register("val_business_duplicates", v.with_views("""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, CAST(count(*) AS BIGINT) AS distinct_trips
FROM (SELECT count(*) AS n FROM trips GROUP BY fare_amount, pickup_datetime, pickup_longitude, pickup_latitude,
      dropoff_longitude, dropoff_latitude, passenger_count)""", "trips"))
def _val_bdup(spark, sf):
    """VAL-12: duplicates on the 7 trip columns."""
    return val.business_key_duplicates(v.trips(spark, sf))


@register("val_strict_fare", v.with_views("""
SELECT CAST(count(*) FILTER (WHERE fare_amount < 2.5e0) AS BIGINT) AS n_low,
       CAST(count(*) FILTER (WHERE fare_amount > 250e0) AS BIGINT) AS n_high,
       round(100e0 * count(*) FILTER (WHERE fare_amount < 2.5e0 OR fare_amount > 250e0) / count(*), 6) AS pct_removed,
       CAST(count(*) FILTER (WHERE fare_amount BETWEEN 2.5e0 AND 250e0) AS BIGINT) AS n_kept
FROM trips""", "trips"))
def _val_strict(spark, sf):
    """VAL-13: strict fare rule [2.50, 250] with counts and share removed."""
    t = v.trips(spark, sf)
    f = F.col("fare_amount")
    return t.agg(F.count_if(f < 2.5).alias("n_low"), F.count_if(f > 250.0).alias("n_high"),
                 rnd(F.lit(100.0) * F.count_if((f < 2.5) | (f > 250.0)) / F.count(F.lit(1))).alias("pct_removed"),
                 F.count_if(f.between(2.5, 250.0)).alias("n_kept"))


@register("val_tight_box", v.with_views("""
SELECT CAST(count(*) FILTER (WHERE NOT (pickup_longitude BETWEEN -74.3e0 AND -73.7e0 AND pickup_latitude BETWEEN 40.5e0 AND 41.0e0)) AS BIGINT) AS pickup_outside,
       CAST(count(*) FILTER (WHERE NOT (dropoff_longitude BETWEEN -74.3e0 AND -73.7e0 AND dropoff_latitude BETWEEN 40.5e0 AND 41.0e0)) AS BIGINT) AS dropoff_outside,
       CAST(count(*) FILTER (WHERE pickup_longitude = 0 AND pickup_latitude = 0) AS BIGINT) AS null_island
FROM trips""", "trips"))
def _val_box(spark, sf):
    """VAL-14/VAL-15: tight box outside counts per end; null-island pickups."""
    t = v.trips(spark, sf)

    def inside(lon, lat):
        return F.col(lon).between(-74.3, -73.7) & F.col(lat).between(40.5, 41.0)

    return t.agg(F.count_if(~inside("pickup_longitude", "pickup_latitude")).alias("pickup_outside"),
                 F.count_if(~inside("dropoff_longitude", "dropoff_latitude")).alias("dropoff_outside"),
                 F.count_if((F.col("pickup_longitude") == 0) & (F.col("pickup_latitude") == 0)).alias("null_island"))


@register("val_passenger_quality", v.with_views("""
SELECT CAST(count(*) FILTER (WHERE passenger_count = 0) AS BIGINT) AS zero_passengers,
       CAST(count(*) FILTER (WHERE passenger_count > 6) AS BIGINT) AS over_six,
       round(100e0 * count(*) FILTER (WHERE passenger_count = 0) / count(*), 6) AS pct_zero,
       round(100e0 * count(*) FILTER (WHERE passenger_count > 6) / count(*), 6) AS pct_over_six
FROM trips""", "trips"))
def _val_pass(spark, sf):
    """VAL-16: passenger count 0 and > 6 as two separate signals."""
    t = v.trips(spark, sf)
    p = F.col("passenger_count")
    n = F.count(F.lit(1))
    return t.agg(F.count_if(p == 0).alias("zero_passengers"), F.count_if(p > 6).alias("over_six"),
                 rnd(F.lit(100.0) * F.count_if(p == 0) / n).alias("pct_zero"),
                 rnd(F.lit(100.0) * F.count_if(p > 6) / n).alias("pct_over_six"))


@register("val_distance_rule", v.with_views("""
, d AS (SELECT trip_distance_km AS km FROM f0)
SELECT CAST(count(*) FILTER (WHERE km < 0.05e0) AS BIGINT) AS too_short,
       CAST(count(*) FILTER (WHERE km > 100e0) AS BIGINT) AS too_long,
       CAST(count(*) FILTER (WHERE km < 0.01e0) AS BIGINT) AS near_zero,
       CAST(count(*) FILTER (WHERE km BETWEEN 0.05e0 AND 100e0) AS BIGINT) AS kept
FROM d""", "features"))
def _val_dist(spark, sf):
    """VAL-17: distance rule [0.05, 100] km with short / long / near-zero counts,
    on the distances of all clean trips (before FT-0 drops the long ones)."""
    d = v.clean_trips(spark, sf).withColumns(ft.distance_columns())
    km = F.col("trip_distance_km")
    return d.agg(F.count_if(km < 0.05).alias("too_short"), F.count_if(km > 100.0).alias("too_long"),
                 F.count_if(km < 0.01).alias("near_zero"), F.count_if(km.between(0.05, 100.0)).alias("kept"))


def fare_per_km_filter(df, fold: float = 1.5, exact: bool = True):
    """VAL-18: drop non-airport rows whose fare/km is outside Q1-1.5 IQR .. Q3+1.5 IQR.

    Bounds come from non-airport rows only; airport rows are always kept;
    a zero-distance non-airport row (ratio undefined) counts as an outlier.
    """
    df = df.withColumn("fare_per_km", ft.fare_per_km())
    base = df.where(F.col("airport_trip") == 0)
    q = qt.quantile_values(base, ["fare_per_km"], [0.25, 0.75], exact=exact)
    q1, q3 = q[((), "fare_per_km", 0.25)], q[((), "fare_per_km", 0.75)]
    iqr = q3 - q1
    lo, hi = q1 - fold * iqr, q3 + fold * iqr
    keep = (F.col("airport_trip") == 1) | F.coalesce(F.col("fare_per_km").between(lo, hi), F.lit(False))
    return df.where(keep), lo, hi


@register("val_fare_per_km_iqr", v.with_views("""
, r AS (SELECT *, CASE WHEN trip_distance_km = 0 THEN NULL ELSE fare_amount / trip_distance_km END AS fare_per_km FROM features),
b AS (SELECT quantile_cont(fare_per_km, 0.25) AS q1, quantile_cont(fare_per_km, 0.75) AS q3 FROM r WHERE airport_trip = 0)
SELECT round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound,
  CAST((SELECT count(*) FROM r WHERE airport_trip = 1 OR coalesce(fare_per_km BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1), false)) AS BIGINT) AS rows_kept,
  CAST((SELECT count(*) FROM r) AS BIGINT) AS rows_in
FROM b""", "features"))
def _val_iqr(spark, sf):
    """VAL-18: fare-per-km IQR outlier filter (bounds from non-airport rows)."""
    d = v.features(spark, sf)
    kept, lo, hi = fare_per_km_filter(d)
    n_in = d.count()
    return kept.agg(rnd(F.lit(lo)).alias("lower_bound"), rnd(F.lit(hi)).alias("upper_bound"),
                    F.count(F.lit(1)).alias("rows_kept"), F.lit(n_in).cast("bigint").alias("rows_in"))


@register("val_quarantine_anti_join", v.with_views("""
, q AS (SELECT DISTINCT event_id FROM trips
        WHERE NOT coalesce(fare_amount BETWEEN 2.5e0 AND 300e0 AND passenger_count BETWEEN 1 AND 6
          AND pickup_latitude BETWEEN 40.40e0 AND 41.20e0 AND dropoff_latitude BETWEEN 40.40e0 AND 41.20e0
          AND pickup_longitude BETWEEN -74.60e0 AND -72.80e0 AND dropoff_longitude BETWEEN -74.60e0 AND -72.80e0
          AND NOT (pickup_latitude = dropoff_latitude AND pickup_longitude = dropoff_longitude), false))
SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_trips
FROM trips t WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.event_id = t.event_id)""", "trips"))
def _val_quarantine(spark, sf):
    """JN-4: quarantine the ids of rows failing any rule, then drop them with a left-anti join."""
    t = v.trips(spark, sf)
    ok = F.lit(True)
    for _, keep in val.rule_columns(types=dict(t.dtypes)):
        ok = ok & keep
    quarantine = t.where(~F.coalesce(ok, F.lit(False))).select("event_id").distinct()
    kept = t.join(quarantine, "event_id", "left_anti")
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_trips"))
