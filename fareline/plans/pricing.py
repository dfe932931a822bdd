"""Queries for the pricing rules (PRC-*, JN-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pricing as prc
from ..sources import tables
from . import register
from . import views as v
from .common import rnd, sql_round_half_even_exact

_BAND_SQL = ("CASE WHEN {f} >= 0 AND {f} < 10 THEN 'LOW' WHEN {f} >= 10 AND {f} < 30 THEN 'MEDIUM' "
             "WHEN {f} >= 30 AND {f} < 70 THEN 'HIGH' WHEN {f} >= 70 AND {f} < 10000 THEN 'PREMIUM' ELSE 'PREMIUM' END")
_CLAMP_SQL = "greatest(least({p}, 300e0), 2.5e0)"
_FLAG_SQL = ("CASE WHEN airport_trip = 1 THEN 'AIRPORT_FLAT_CANDIDATE' "
             "WHEN is_rush_hour = 1 AND trip_distance_km > 5 THEN 'SURGE_ELIGIBLE' ELSE {other} END")

SCORED_SQL = f"""
, scored AS (
  SELECT f.event_id, f.airport_trip, f.is_rush_hour, f.trip_distance_km, p.actual_fare, p.predicted_fare,
         {_CLAMP_SQL.format(p='p.predicted_fare')} AS clamped_fare,
         {_FLAG_SQL.format(other="'NORMAL'")} AS pricing_flag
  FROM features f JOIN pairs p ON f.event_id = p.event_id
)"""


def scored(spark, sf):
    """Feature rows with their (actual, predicted) pair, priced.

    The pair is a projection of the same clean row, so it is added as
    columns (no join, no extra shuffle)."""
    f = v.features(spark, sf).withColumns(tables.pair_columns())
    return prc.price_trips(f)


@register("prc_pricing", v.with_views(SCORED_SQL + f"""
SELECT event_id, round(clamped_fare, 6) AS clamped_fare, {_BAND_SQL.format(f='clamped_fare')} AS fare_band, pricing_flag
FROM scored""", "features", "pairs"))
def _prc(spark, sf):
    """PRC-1/2/3: clamped fare, band of the clamped fare and batch flag per trip."""
    s = scored(spark, sf)
    return s.select("event_id", rnd("clamped_fare").alias("clamped_fare"), "fare_band", "pricing_flag")


@register("prc_flag_band_counts", v.with_views(SCORED_SQL + f"""
SELECT pricing_flag, {_BAND_SQL.format(f='clamped_fare')} AS fare_band, count(*) AS n_trips
FROM scored GROUP BY 1, 2""", "features", "pairs"))
def _prc_counts(spark, sf):
    """PRC-2/PRC-3 summary: trips per flag and band."""
    return scored(spark, sf).groupBy("pricing_flag", "fare_band").agg(F.count(F.lit(1)).alias("n_trips"))


@register("prc_band_range_join", v.with_views(SCORED_SQL + """
, bands AS (SELECT * FROM (VALUES ('LOW', 0e0, 10e0), ('MEDIUM', 10e0, 30e0), ('HIGH', 30e0, 70e0), ('PREMIUM', 70e0, 10000e0)) t(band, lo, hi))
SELECT coalesce(b.band, 'PREMIUM') AS fare_band, count(*) AS n_trips
FROM scored s LEFT JOIN bands b ON s.predicted_fare >= b.lo AND s.predicted_fare < b.hi
GROUP BY 1""", "features", "pairs"))
def _prc_join(spark, sf):
    """JN-3: band of the raw prediction by a non-equi left join to the band table."""
    s = scored(spark, sf)
    j = prc.band_by_range_join(s, "predicted_fare", prc.band_table(spark))
    return j.groupBy("fare_band").agg(F.count(F.lit(1)).alias("n_trips"))


@register("prc_score_trip", v.with_views(SCORED_SQL + f"""
SELECT event_id, {sql_round_half_even_exact(_CLAMP_SQL.format(p='predicted_fare'), 2)} AS predicted_fare_usd,
  {_BAND_SQL.format(f=_CLAMP_SQL.format(p='predicted_fare'))} AS fare_band,
  {_FLAG_SQL.format(other='CAST(NULL AS VARCHAR)')} AS pricing_flag
FROM scored""", "features", "pairs"))
def _prc_score(spark, sf):
    """PRC-4: single-trip output per trip (cents half-even, NULL flag when normal)."""
    s = scored(spark, sf)
    cols = prc.score_columns("predicted_fare")
    return s.select("event_id", *[c.alias(k) for k, c in cols.items()])
