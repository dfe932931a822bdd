"""Queries for error metrics, cost, leakage and drift (MET-*, LKG-*, DRF-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as met
from ..sources import tables
from . import register
from . import views as v
from .common import rnd
from .common import sql_round_half_even_exact as rhe

MET_SQL = v.with_views("""
SELECT count(*) AS n,
  round(sqrt(avg(pow(predicted_fare - actual_fare, 2))), 6) AS rmse,
  round(avg(abs(predicted_fare - actual_fare)), 6) AS mae,
  round(avg(abs(predicted_fare - actual_fare) / greatest(abs(actual_fare), 2.220446049250313e-16)), 6) AS mape,
  round(1 - sum(pow(predicted_fare - actual_fare, 2)) / (var_pop(actual_fare) * count(*)), 6) AS r2,
  round(avg(CAST(abs(predicted_fare - actual_fare) / greatest(actual_fare, 1e-6) <= 0.15 AS DOUBLE)), 6) AS within_tol,
  round(1 - (1 - (1 - sum(pow(predicted_fare - actual_fare, 2)) / (var_pop(actual_fare) * count(*)))) * (count(*) - 1) / (count(*) - 10 - 1), 6) AS adjusted_r2
FROM pairs""", "pairs")


@register("met_errors", MET_SQL)
def _met(spark, sf):
    """MET-1..4: RMSE, MAE, MAPE, R2, adjusted R2 (10 features), within 15%."""
    m = met.regression_metrics(v.pairs(spark, sf), n_features=10)
    return m.select("n", *[rnd(c).alias(c) for c in ("rmse", "mae", "mape", "r2", "within_tol", "adjusted_r2")])


@register("met_errors_by_side", v.with_views("""
, p AS (SELECT t.side, p.* FROM pairs p JOIN two_sides t USING (event_id))
SELECT side, count(*) AS n,
  round(sqrt(avg(pow(predicted_fare - actual_fare, 2))), 6) AS rmse,
  round(avg(abs(predicted_fare - actual_fare)), 6) AS mae,
  round(1 - sum(pow(predicted_fare - actual_fare, 2)) / (var_pop(actual_fare) * count(*)), 6) AS r2
FROM p GROUP BY side""", "pairs", "two_sides"))
def _met_side(spark, sf):
    """MET-1..3 grouped (per period), e.g. train vs test R2 and their gap."""
    s = v.two_sides(spark, sf)
    m = met.regression_metrics(s.select("side", *[c.alias(k) for k, c in tables.pair_columns().items()]), by=["side"])
    return m.select("side", "n", rnd("rmse").alias("rmse"), rnd("mae").alias("mae"), rnd("r2").alias("r2"))


@register("met_cost", v.with_views(f"""
, e AS (SELECT predicted_fare - actual_fare AS err FROM pairs),
s AS (SELECT count(*) AS n, count(*) FILTER (WHERE err < 0) AS under_priced_trips, count(*) FILTER (WHERE err > 0) AS over_priced_trips,
  coalesce(sum(abs(err)) FILTER (WHERE err < 0), 0) * 1.00 AS u, coalesce(sum(abs(err)) FILTER (WHERE err > 0), 0) * 0.35 AS o FROM e)
SELECT under_priced_trips, over_priced_trips, {rhe('u', 2)} AS estimated_revenue_loss, {rhe('o', 2)} AS estimated_trust_cost,
  {rhe('u + o', 2)} AS total_estimated_cost, {rhe('(u + o) / greatest(n, 1)', 4)} AS avg_cost_per_trip FROM s""", "pairs"))
def _met_cost(spark, sf):
    """MET-5: cost-sensitive evaluation (under 1.00 / over 0.35 per dollar)."""
    return met.cost_evaluation(v.pairs(spark, sf))


LEAK_COLS = ("passenger_count", "trip_distance_km", "manhattan_distance_km", "pickup_hour", "is_rush_hour",
             "airport_trip", "distance_per_passenger", "pickup_dist_from_center_km")
_INT_COLS = {"passenger_count": "BIGINT", "pickup_hour": "INTEGER", "is_rush_hour": "INTEGER", "airport_trip": "INTEGER"}


def _leak_sql():
    parts = []
    for c in LEAK_COLS:
        cast = f"CAST(trunc(fare_amount) AS {_INT_COLS[c]})" if c in _INT_COLS else "fare_amount"
        r = f"abs(covar_pop({c}, fare_amount) / nullif(stddev_pop({c}) * stddev_pop(fare_amount), 0))"
        parts.append(f"SELECT '{c}' AS column, bool_and({c} IS NOT DISTINCT FROM {cast}) AS exact_match, round({r}, 6) AS abs_corr, "
                     f"bool_and({c} IS NOT DISTINCT FROM {cast}) OR coalesce({r} >= 0.98, false) AS leak_flag FROM features")
    return v.with_views(" UNION ALL ".join(parts), "features")


@register("lkg_leakage", _leak_sql())
def _lkg(spark, sf):
    """LKG-1/LKG-2: exact-match-after-cast and |r| >= 0.98 leakage flags vs the fare."""
    r = met.leakage_report(v.features(spark, sf), "fare_amount", LEAK_COLS)
    return r.withColumn("abs_corr", rnd("abs_corr"))


PSI_COLS = ("fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
            "trip_distance_km", "manhattan_distance_km", "bearing_deg", "pickup_dist_from_center_km",
            "distance_per_passenger", "distance_x_rush_hour", "passenger_count")


def psi_cte() -> str:
    """The PSI computation as CTE text ending in ``res(feature, drift_score)``."""
    sql = _psi_sql()
    return sql[sql.index(", fs AS (") + 2:sql.rindex("SELECT feature, round(drift_score")].rstrip()


def _psi_sql(extra_select: str = "", order: str = "") -> str:
    unions = " UNION ALL ".join(f"SELECT side, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM fs" for c in PSI_COLS)
    return v.with_views(f"""
, fs AS (SELECT CASE WHEN pickup_datetime < TIMESTAMP '2024-01-16 00:00:00' THEN 'expected' ELSE 'actual' END AS side, * FROM features),
l AS ({unions}),
e AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges
      FROM l WHERE side = 'expected' GROUP BY feature),
n AS (SELECT feature, side, count(*) AS n FROM l GROUP BY feature, side),
b AS (SELECT l.feature, l.side, greatest(1, least(len(list_filter(e.edges, lambda q: q <= l.x)), len(e.edges) - 1)) AS bin, count(*) AS c
      FROM l JOIN e ON l.feature = e.feature WHERE len(e.edges) >= 2 GROUP BY 1, 2, 3),
g AS (SELECT e.feature, s.side, r.bin FROM e, (VALUES ('expected'), ('actual')) s(side), range(1, 11) r(bin) WHERE r.bin <= len(e.edges) - 1),
sh AS (SELECT g.feature, g.side, g.bin, coalesce(b.c, 0) / (coalesce(n.n, 0) + 1e-9) AS s0 FROM g
       LEFT JOIN b ON g.feature = b.feature AND g.side = b.side AND g.bin = b.bin
       LEFT JOIN n ON g.feature = n.feature AND g.side = n.side),
sh2 AS (SELECT feature, side, bin, CASE WHEN s0 = 0 THEN 1e-6 ELSE s0 END AS s FROM sh),
w AS (SELECT feature, bin, max(s) FILTER (WHERE side = 'expected') AS ex, max(s) FILTER (WHERE side = 'actual') AS ac FROM sh2 GROUP BY 1, 2),
p AS (SELECT feature, sum((ex - ac) * ln(ex / ac)) AS drift_score FROM w GROUP BY feature),
res AS (SELECT f.feature, coalesce(p.drift_score, 0e0) AS drift_score FROM (SELECT DISTINCT feature FROM l) f LEFT JOIN p USING (feature))
SELECT feature, round(drift_score, 6) AS drift_score{extra_select} FROM res {order}""", "features")


def _psi_df(spark, sf):
    f = v.features(spark, sf)
    is_exp = F.col("pickup_datetime") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return met.psi(f.withColumn("side", F.when(is_exp, "expected").otherwise("actual")), "side", PSI_COLS)


@register("drf_psi", _psi_sql())
def _drf_psi(spark, sf):
    """DRF-1/DRF-2: PSI per continuous feature, first half of the month vs second half."""
    return _psi_df(spark, sf).select("feature", rnd("drift_score").alias("drift_score"))


@register("drf_psi_status", _psi_sql(", CASE WHEN drift_score >= 0.20 THEN 'CRITICAL' WHEN drift_score >= 0.10 THEN 'MODERATE' ELSE 'OK' END AS status"))
def _drf_status(spark, sf):
    """DRF-3: drift status per feature."""
    p = _psi_df(spark, sf)
    return p.select("feature", rnd("drift_score").alias("drift_score"), met.psi_status().alias("status"))


MS_COLS = ("fare_amount", "trip_distance_km", "passenger_count", "pickup_hour", "bearing_deg", "airport_trip")


@register("drf_mean_shift", v.with_views(
    ", fs AS (SELECT CASE WHEN pickup_datetime < TIMESTAMP '2024-01-16 00:00:00' THEN 'expected' ELSE 'actual' END AS side, * FROM features),\n"
    "s AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) FILTER (WHERE side = 'expected') AS mr, stddev_samp({c}) FILTER (WHERE side = 'expected') AS sr, "
        f"avg({c}) FILTER (WHERE side = 'actual') AS mn FROM fs" for c in MS_COLS) + ")\n"
    "SELECT feature, round(abs(mr - mn) / CASE WHEN sr = 0 THEN 1 ELSE sr END, 6) AS shift FROM s "
    "ORDER BY abs(mr - mn) / CASE WHEN sr = 0 THEN 1 ELSE sr END DESC, feature LIMIT 5", "features"))
def _drf_shift(spark, sf):
    """DRF-4: top-5 standardised mean shifts between the two halves."""
    f = v.features(spark, sf)
    is_exp = F.col("pickup_datetime") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return met.mean_shift(f.where(is_exp), f.where(~is_exp), MS_COLS, top_n=5).withColumn("shift", rnd("shift"))
