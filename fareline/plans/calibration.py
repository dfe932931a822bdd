"""Queries for interval calibration (CAB-*) and end-to-end scoring (PRC-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import models as md
from ..operators import pricing as prc
from ..operators import prep as pp
from ..operators import quantiles as qt
from . import register
from . import views as v
from .common import rnd
from .models import fitted
from .monitoring import HASH_SQL

_DECILES = [i / 10 for i in range(1, 10)]


def bucket_width_calibration(df, pred: str, actual: str, coverage: float = 0.9):
    """CAB-2 with a bucket-mean width: width(pred) = mean |res| in the prediction
    decile (exact edges); k = exact quantile(|res| / max(width, 1e-6), coverage)."""
    qv = qt.quantile_values(df, [pred], _DECILES)
    edges = sorted({qv[((), pred, p)] for p in _DECILES})
    arr = F.array(*[F.lit(float(e)) for e in edges])
    d = df.select(F.size(F.filter(arr, lambda q: q <= F.col(pred))).alias("bucket"),
                  F.abs(F.col(actual) - F.col(pred)).alias("r"))
    widths = d.groupBy("bucket").agg(F.avg("r").alias("width"))
    j = d.join(F.broadcast(widths), "bucket").withColumn("ratio", F.col("r") / F.greatest("width", F.lit(1e-6)))
    k = qt.quantile_values(j, ["ratio"], [coverage])[((), "ratio", coverage)]
    cov = j.agg(F.avg((F.col("r") <= F.lit(k) * F.col("width")).cast("double")).alias("c")).first()["c"]
    return k, cov


@register("cab_bucket_width", v.with_views(f"""
, cal AS (SELECT * FROM pairs WHERE {HASH_SQL} >= 64 AND {HASH_SQL} < 80),
e AS (SELECT list_sort(list_distinct(quantile_cont(predicted_fare, {_DECILES}))) AS edges FROM cal),
d AS (SELECT len(list_filter(e.edges, lambda q: q <= predicted_fare)) AS bucket, abs(actual_fare - predicted_fare) AS r FROM cal, e),
w AS (SELECT bucket, avg(r) AS width FROM d GROUP BY bucket),
j AS (SELECT d.r, w.width, d.r / greatest(w.width, 1e-6) AS ratio FROM d JOIN w USING (bucket)),
k AS (SELECT quantile_cont(ratio, 0.9) AS k FROM j)
SELECT round(k.k, 6) AS k, round(avg(CAST(j.r <= k.k * j.width AS DOUBLE)), 6) AS empirical_coverage FROM j, k GROUP BY k.k""",
                                           "pairs"))
def _cab_bucket(spark, sf):
    """CAB-2 (SQL form): 90% interval scale k and its coverage on the calibration split."""
    p = v.pairs(spark, sf)
    hb = pp.hash_bucket()
    cal = p.where((hb >= 64) & (hb < 80))
    k, cov = bucket_width_calibration(cal, "predicted_fare", "actual_fare")
    return spark.createDataFrame([(float(k), float(cov))], "k double, empirical_coverage double").select(
        rnd("k").alias("k"), rnd("empirical_coverage").alias("empirical_coverage"))


# --- a rule as predictor: the calibration itself with a SQL oracle --------------------------

# the isotonic fit by its max-min formula over the distinct predictions
_RULE_SQL = f"""
, rule AS (SELECT floor(predicted_fare) AS x, actual_fare, abs(actual_fare - floor(predicted_fare)) AS r, {HASH_SQL} AS hb FROM pairs),
cal AS (SELECT * FROM rule WHERE hb >= 64 AND hb < 80),
pts AS (SELECT x, sum(r) AS s, count(*) AS w FROM cal GROUP BY x),
acc AS (SELECT x, row_number() OVER (ORDER BY x) AS i, sum(s) OVER (ORDER BY x) AS s1, sum(w) OVER (ORDER BY x) AS w1, s, w FROM pts),
means AS (SELECT j.i AS j, k.i AS k, (k.s1 - j.s1 + j.s) / (k.w1 - j.w1 + j.w) AS m FROM acc j JOIN acc k ON j.i <= k.i),
low AS (SELECT a.i, b.j, min(b.m) AS m FROM acc a JOIN means b ON b.j <= a.i AND b.k >= a.i GROUP BY a.i, b.j),
steps AS (SELECT a.x, a.w AS n, max(l.m) AS width FROM acc a JOIN low l ON l.i = a.i GROUP BY a.x, a.w),
k AS (SELECT quantile_cont(r / greatest(width, 1e-6), 0.9) AS k FROM cal JOIN steps USING (x))"""


def rule_rows(spark, sf):
    """Whole dollars of the given prediction, absolute residual and split of every pair."""
    p = v.pairs(spark, sf).withColumn("split", pp.split_label())
    return p.select("split", "actual_fare", F.floor("predicted_fare").cast("double").alias("x"))


def _rule_calibration(spark, sf):
    rows = rule_rows(spark, sf)
    return rows, *md.calibrate(rows.where(F.col("split") == "calibration"), label="actual_fare", prediction="x")


@register("cab_isotonic_steps", v.with_views(_RULE_SQL + "\nSELECT x, n, round(width, 6) AS width FROM steps", "pairs"))
def _cab_steps(spark, sf):
    """CAB-1 on a given prediction: the exact isotonic half-width at every distinct prediction of the calibration split."""
    rows, fit, _cal = _rule_calibration(spark, sf)
    points = rows.where(F.col("split") == "calibration").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    return points.select("x", "n", F.round(fit.predict(F.col("x")), 6).alias("width"))


@register("cab_interval_rule", v.with_views(_RULE_SQL + """
, ends AS (SELECT t.r, t.x, lo.x AS x0, lo.width AS w0, hi.x AS x1, hi.width AS w1 FROM (SELECT * FROM rule WHERE hb >= 80) t
  ASOF LEFT JOIN steps lo ON t.x >= lo.x ASOF LEFT JOIN steps hi ON t.x <= hi.x),
w AS (SELECT r, CASE WHEN x0 IS NULL THEN w1 WHEN x1 IS NULL OR x0 = x1 THEN w0 ELSE w0 + (w1 - w0) * (x - x0) / (x1 - x0) END AS w FROM ends)
SELECT count(*) AS n, round(k.k, 6) AS k, round(avg(CAST(r <= k.k * w AS DOUBLE)), 6) AS test_coverage, round(avg(2 * k.k * w), 6) AS mean_width
FROM w, k GROUP BY k.k""", "pairs"))
def _cab_interval_rule(spark, sf):
    """CAB-2/CAB-3 on a given prediction: k, and coverage and mean width of the intervals on the test split."""
    rows, fit, cal = _rule_calibration(spark, sf)
    iv = md.predict_with_interval(rows.where(F.col("split") == "test"), fit, cal, prediction="x")
    inside = F.col("actual_fare").between(F.col("lower"), F.col("upper"))
    return iv.agg(F.count(F.lit(1)).alias("n"), F.lit(round(cal.k, 6)).alias("k"), F.round(F.avg(inside.cast("double")), 6).alias("test_coverage"),
                  F.round(F.avg(F.col("upper") - F.col("lower")), 6).alias("mean_width"))


def _calibrated(spark, sf):
    model, prep, f = fitted(spark, sf, "linear")
    cal = model.transform(prep.transform(f.where(F.col("split") == "calibration")))
    iso, c = md.calibrate(cal.select("fare_amount", "prediction"))
    return model, prep, f, iso, c


@register("cab_isotonic")
def _cab_iso(spark, sf):
    """CAB-1/CAB-2: isotonic |residual| model on the calibration split; k and empirical coverage."""
    _m, _p, _f, _iso, c = _calibrated(spark, sf)
    return spark.createDataFrame([(c.k, c.coverage, c.empirical_coverage)],
                                 "k double, coverage double, empirical_coverage double")


@register("cab_interval")
def _cab_interval(spark, sf):
    """CAB-3: prediction intervals on the test split and their realised coverage."""
    model, prep, f, iso, c = _calibrated(spark, sf)
    te = model.transform(prep.transform(f.where(F.col("split") == "test")))
    iv = md.predict_with_interval(te, iso, c)
    inside = (F.col("fare_amount") >= F.col("lower")) & (F.col("fare_amount") <= F.col("upper"))
    return iv.agg(F.count(F.lit(1)).alias("n"), F.avg(inside.cast("double")).alias("test_coverage"),
                  F.avg(F.col("upper") - F.col("lower")).alias("mean_width"))


@register("prc_end_to_end")
def _e2e(spark, sf):
    """PRC-5: features -> model -> interval -> pricing output of every clean trip; a trip
    above the distance limit has no price but a reason."""
    model, prep, _f, iso, c = _calibrated(spark, sf)
    every = ft.add_engineered_features(v.clean_trips(spark, sf), drop_long=False)
    iv = md.predict_with_interval(model.transform(prep.transform(every)), iso, c)
    cols = prc.score_every_trip(iv, "prediction", "lower", "upper")
    return iv.select("event_id", *[e.alias(k) for k, e in cols.items()])


@register("prc_unpriced", v.with_views("""
SELECT event_id, CASE WHEN trip_distance_km > 100e0 THEN 'DISTANCE_ABOVE_LIMIT' END AS unpriced_reason,
  CASE WHEN trip_distance_km <= 100e0 THEN round(greatest(least(fare_amount * 0.8e0, 300e0), 2.5e0), 2) END AS predicted_fare_usd
FROM f0""", "features"))
def _unpriced(spark, sf):
    """PRC-5 on a given prediction (0.8 times the fare): one row per clean trip, priced or with a reason."""
    every = ft.add_engineered_features(v.clean_trips(spark, sf), drop_long=False)
    every = every.withColumn("prediction", F.col("fare_amount") * F.lit(0.8))
    cols = prc.score_every_trip(every)
    return every.select("event_id", cols["unpriced_reason"].alias("unpriced_reason"), F.round(
        F.when(cols["unpriced_reason"].isNull(), prc.clamp_fare("prediction")), 2).alias("predicted_fare_usd"))
