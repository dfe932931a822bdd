"""Queries for the profiling aggregates (PRF-*) and the grid map (GEO-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as prf
from ..operators import quantiles as qt
from . import register
from . import views as v
from .common import rnd

DESCRIBE_COLS = ("fare_amount", "trip_distance_km", "passenger_count", "pickup_hour")


@register("prf_hourly", v.with_views("""
SELECT pickup_hour, count(*) AS n_trips, round(avg(fare_amount), 6) AS mean_fare,
       round(quantile_cont(fare_amount, 0.5), 6) AS median_fare
FROM features GROUP BY pickup_hour""", "features"))
def prf_hourly(spark, sf):
    """PRF-10 (flagship): trips per local hour with mean and exact median fare."""
    f = v.features(spark, sf).select("pickup_hour", "fare_amount")
    med = qt.quantiles(f, ["fare_amount"], [0.5], ["pickup_hour"]).select(
        "pickup_hour", F.col("value").alias("_median"))
    agg = f.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("n_trips"), F.avg("fare_amount").alias("_mean"))
    return agg.join(F.broadcast(med), "pickup_hour").select(
        "pickup_hour", "n_trips", rnd("_mean").alias("mean_fare"), rnd("_median").alias("median_fare"))


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS dtype, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, "
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, "
    f"round(100e0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct_null FROM trips"
    for c, t in (("event_id", "bigint"), ("event_type", "string"), ("fare_amount", "double"),
                 ("pickup_datetime", "timestamp_ntz"), ("pickup_longitude", "double"),
                 ("pickup_latitude", "double"), ("dropoff_longitude", "double"),
                 ("dropoff_latitude", "double"), ("passenger_count", "bigint")))


@register("prf_columns", v.with_views(_PROFILE_SQL, "trips"))
def _prf_columns(spark, sf):
    """PRF-1: dtype, distinct, nulls and null % per column of the raw trips."""
    p = prf.column_profile(v.trips(spark, sf))
    return p.withColumn("pct_null", rnd("pct_null"))


@register("prf_missing", v.with_views(f"""
, p AS ({_PROFILE_SQL})
SELECT "column", n_null, pct_null FROM p WHERE n_null > 0
UNION ALL
SELECT 'TOTAL' AS column, CAST(sum(n_null) AS BIGINT) AS n_null, CAST(NULL AS DOUBLE) AS pct_null FROM p""", "trips"))
def _prf_missing(spark, sf):
    """PRF-2: columns with missing values, plus the total missing cells."""
    p = prf.column_profile(v.trips(spark, sf)).where("n_null > 0").select(
        "column", "n_null", rnd("pct_null").alias("pct_null"))
    tot = p.agg(F.lit("TOTAL").alias("column"), F.sum("n_null").cast("bigint").alias("n_null"),
                F.lit(None).cast("double").alias("pct_null"))
    return p.unionByName(tot)


def _describe_sql(by: str | None) -> str:
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}, feature" if by else "GROUP BY feature"
    unions = " UNION ALL ".join(f"SELECT {sel}'{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM features"
                                for c in DESCRIBE_COLS)
    return v.with_views(f"""
, l AS ({unions})
SELECT {sel}feature, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
  round(quantile_cont(v, 0.75), 6) AS q75, round(max(v), 6) AS max, round(max(v) - min(v), 6) AS range
FROM l WHERE v IS NOT NULL {grp}""", "features")


def _describe(spark, sf, by=()):
    d = prf.describe(v.features(spark, sf), DESCRIBE_COLS, by)
    return d.select(*by, "feature", "count", *[rnd(c).alias(c) for c in
                                                ("mean", "std", "min", "q25", "q50", "q75", "max", "range")])


@register("prf_describe", _describe_sql(None))
def _prf_describe(spark, sf):
    """PRF-3: describe() with exact quartiles and range."""
    return _describe(spark, sf)


@register("prf_describe_by_airport", _describe_sql("airport_trip"))
def _prf_describe_airport(spark, sf):
    """PRF-3 grouped form: describe() per airport flag."""
    return _describe(spark, sf, ["airport_trip"])


@register("prf_minmax_summary", v.with_views("""
, s AS (
  SELECT 'fare_amount' AS feature, avg(fare_amount) AS mean, stddev_samp(fare_amount) AS std, min(fare_amount) AS min, max(fare_amount) AS max FROM features
  UNION ALL SELECT 'trip_distance_km', avg(trip_distance_km), stddev_samp(trip_distance_km), min(trip_distance_km), max(trip_distance_km) FROM features
  UNION ALL SELECT 'passenger_count', avg(passenger_count), stddev_samp(passenger_count), min(passenger_count), max(passenger_count) FROM features
  UNION ALL SELECT 'pickup_hour', avg(pickup_hour), stddev_samp(pickup_hour), min(pickup_hour), max(pickup_hour) FROM features
)
SELECT feature,
  round((mean - min(mean) OVER ()) / nullif(max(mean) OVER () - min(mean) OVER (), 0), 6) AS mean,
  round((std - min(std) OVER ()) / nullif(max(std) OVER () - min(std) OVER (), 0), 6) AS std,
  round((min - min(min) OVER ()) / nullif(max(min) OVER () - min(min) OVER (), 0), 6) AS min,
  round((max - min(max) OVER ()) / nullif(max(max) OVER () - min(max) OVER (), 0), 6) AS max
FROM s""", "features"))
def _prf_minmax(spark, sf):
    """PRF-4: each summary statistic min-max scaled across the columns."""
    f = v.features(spark, sf)
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                        for c in DESCRIBE_COLS])
    s = f.select(F.inline(entries)).groupBy("feature").agg(
        F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    n = prf.minmax_normalise(s, ["mean", "std", "min", "max"])
    return n.select("feature", *[rnd(c).alias(c) for c in ("mean", "std", "min", "max")])


def _shape_sql():
    parts = []
    for c in ("fare_amount", "trip_distance_km"):
        parts.append(f"SELECT '{c}' AS feature, round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurt, "
                     f"round(skewness(ln(1 + {c})), 6) AS log_skew, round(kurtosis(ln(1 + {c})), 6) AS log_kurt FROM features")
    return v.with_views(" UNION ALL ".join(parts), "features")


@register("prf_shape", _shape_sql())
def _prf_shape(spark, sf):
    """PRF-5: bias-corrected skewness / excess kurtosis, raw and log1p."""
    s = prf.shape_stats(v.features(spark, sf), ["fare_amount", "trip_distance_km"])
    return s.select("feature", *[rnd(c).alias(c) for c in ("skew", "kurt", "log_skew", "log_kurt")])


@register("prf_fare_histogram", v.with_views("""
SELECT CAST(least(floor((least(greatest(fare_amount, 0e0), 100e0) - 0e0) / 1e0), 99) AS INTEGER) AS bin,
       count(*) AS count
FROM features GROUP BY 1""", "features"))
def _prf_hist(spark, sf):
    """PRF-6: 100 fixed-width fare bins on [0, 100], values clipped into the end bins."""
    h = prf.histogram(v.features(spark, sf), "fare_amount", 100, 0.0, 100.0)
    return h.select("bin", "count")


@register("prf_boxplot_by_passengers", v.with_views("""
, q AS (SELECT passenger_count, quantile_cont(fare_amount, 0.25) AS q1, quantile_cont(fare_amount, 0.5) AS median,
               quantile_cont(fare_amount, 0.75) AS q3 FROM features GROUP BY passenger_count),
b AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi FROM q)
SELECT b.passenger_count, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
  round(fence_lo, 6) AS fence_lo, round(fence_hi, 6) AS fence_hi, count(*) AS n,
  round(min(fare_amount) FILTER (WHERE fare_amount BETWEEN fence_lo AND fence_hi), 6) AS whisker_lo,
  round(max(fare_amount) FILTER (WHERE fare_amount BETWEEN fence_lo AND fence_hi), 6) AS whisker_hi,
  count(*) FILTER (WHERE fare_amount < fence_lo) AS n_low_outliers,
  count(*) FILTER (WHERE fare_amount > fence_hi) AS n_high_outliers
FROM features f JOIN b ON f.passenger_count = b.passenger_count
GROUP BY b.passenger_count, q1, median, q3, iqr, fence_lo, fence_hi""", "features"))
def _prf_box(spark, sf):
    """PRF-7: box-plot numbers of fare per passenger count."""
    b = prf.box_stats(v.features(spark, sf), "fare_amount", ["passenger_count"])
    return b.select("passenger_count", *[rnd(c).alias(c) for c in ("q1", "median", "q3", "iqr", "fence_lo", "fence_hi")],
                    "n", rnd("whisker_lo").alias("whisker_lo"), rnd("whisker_hi").alias("whisker_hi"),
                    "n_low_outliers", "n_high_outliers")


@register("prf_density_by_airport", v.with_views("""
, h AS (SELECT airport_trip, CAST(least(floor(least(greatest(fare_amount, 0e0), 100e0) / 2e0), 49) AS INTEGER) AS bin,
        count(*) AS count FROM features GROUP BY 1, 2)
SELECT airport_trip, bin, count, round(count / sum(count) OVER (PARTITION BY airport_trip), 6) AS share FROM h""",
                                                  "features"))
def _prf_density(spark, sf):
    """PRF-8: fare distribution per airport flag as a normalised 50-bin histogram (clip 100)."""
    h = prf.histogram(v.features(spark, sf), "fare_amount", 50, 0.0, 100.0, by=["airport_trip"])
    n = prf.normalised_histogram(h, ["airport_trip"])
    return n.select("airport_trip", "bin", "count", rnd("share").alias("share"))


@register("prf_kernel_density", v.with_views("""
, c AS (SELECT airport_trip, greatest(least(fare_amount, 100e0), 0e0) AS v FROM features),
st AS (SELECT airport_trip, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2e0) AS bw FROM c GROUP BY 1),
l AS (SELECT airport_trip, v / (100e0 / 511) AS p, least(floor(v / (100e0 / 511)), 510) AS i FROM c),
cells AS (SELECT airport_trip, i, sum(w) AS w FROM (SELECT airport_trip, i, 1 - (p - i) AS w FROM l UNION ALL SELECT airport_trip, i + 1, p - i FROM l) GROUP BY 1, 2)
SELECT airport_trip, CAST(j AS INTEGER) AS point,
  round(sum(w * exp(-0.5e0 * pow((j - i) * (100e0 / 511) / bw, 2))) / any_value(n * bw * sqrt(2 * pi())), 6) AS density
FROM cells JOIN st USING (airport_trip), range(0, 512) t(j) GROUP BY 1, 2""", "features"))
def _prf_kde(spark, sf):
    """PRF-8: kernel density of the fare (clipped at 100) per airport flag, one bandwidth per group."""
    d = prf.kernel_density(v.features(spark, sf), "fare_amount", 0.0, 100.0, by=["airport_trip"])
    return d.select("airport_trip", "point", rnd("density").alias("density"))


@register("prf_value_counts", v.with_views("""
SELECT passenger_count, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM trips GROUP BY passenger_count""", "trips"))
def _prf_vc(spark, sf):
    """PRF-9: passenger-count value counts on the raw trips."""
    c = prf.value_counts(v.trips(spark, sf), "passenger_count")
    return c.withColumn("share", rnd("share"))


@register("prf_calendar_means", v.with_views("""
SELECT CASE WHEN GROUPING(pickup_dow) = 0 THEN 'dow' WHEN GROUPING(pickup_month) = 0 THEN 'month' ELSE 'year' END AS dimension,
       coalesce(pickup_dow, pickup_month, pickup_year) AS value,
       count(*) AS n_trips, round(avg(fare_amount), 6) AS mean_fare
FROM features GROUP BY GROUPING SETS ((pickup_dow), (pickup_month), (pickup_year))""", "features"))
def _prf_calendar(spark, sf):
    """PRF-11: mean fare by weekday, month and year in one scan (GROUPING SETS)."""
    f = v.features(spark, sf)
    g = f.groupingSets([["pickup_dow"], ["pickup_month"], ["pickup_year"]], "pickup_dow", "pickup_month", "pickup_year")
    a = g.agg(F.grouping("pickup_dow").alias("_gd"), F.grouping("pickup_month").alias("_gm"),
              F.count(F.lit(1)).alias("n_trips"), rnd(F.avg("fare_amount")).alias("mean_fare"))
    dim = F.when(F.col("_gd") == 0, "dow").when(F.col("_gm") == 0, "month").otherwise("year")
    return a.select(dim.alias("dimension"), F.coalesce("pickup_dow", "pickup_month", "pickup_year").alias("value"),
                    "n_trips", "mean_fare")


DIST_EDGES = (0, 1, 2, 3, 5, 8, 12, 20, 100)


def distance_bucket(col="trip_distance_km", edges=DIST_EDGES):
    """Right-closed buckets (a, b]; outside -> NULL (Bucketizer is left-closed)."""
    expr = None
    for a, b in zip(edges[:-1], edges[1:]):
        cond = (F.col(col) > a) & (F.col(col) <= b)
        label = F.lit(f"({a}, {b}]")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def _bucket_sql():
    cases = " ".join(f"WHEN trip_distance_km > {a} AND trip_distance_km <= {b} THEN '({a}, {b}]'"
                     for a, b in zip(DIST_EDGES[:-1], DIST_EDGES[1:]))
    return f"CASE {cases} END"


@register("prf_distance_buckets", v.with_views(f"""
SELECT {_bucket_sql()} AS distance_bucket, count(*) AS n_trips, round(avg(fare_amount), 6) AS mean_fare
FROM features WHERE {_bucket_sql()} IS NOT NULL GROUP BY 1""", "features"))
def _prf_buckets(spark, sf):
    """PRF-12: mean fare by right-closed distance bucket."""
    f = v.features(spark, sf).withColumn("distance_bucket", distance_bucket())
    return f.where(F.col("distance_bucket").isNotNull()).groupBy("distance_bucket").agg(
        F.count(F.lit(1)).alias("n_trips"), rnd(F.avg("fare_amount")).alias("mean_fare"))


@register("prf_airport_share", v.with_views("""
SELECT airport_trip, count(*) AS n_trips, round(avg(fare_amount), 6) AS mean_fare,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM features GROUP BY airport_trip""", "features"))
def _prf_airport(spark, sf):
    """PRF-13: airport share, count and group compare of mean fare."""
    f = v.features(spark, sf)
    g = f.groupBy("airport_trip").agg(F.count(F.lit(1)).alias("n_trips"), F.avg("fare_amount").alias("_m"))
    tot = f.agg(F.count(F.lit(1)).alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select(
        "airport_trip", "n_trips", rnd("_m").alias("mean_fare"), rnd(F.col("n_trips") / F.col("_t")).alias("share"))


@register("prf_anova", v.with_views("""
, g AS (SELECT passenger_count, count(*) AS n, avg(fare_amount) AS m, var_samp(fare_amount) AS v FROM features GROUP BY 1),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * m) / sum(n) AS grand FROM g),
s AS (SELECT sum(n * pow(m - grand, 2)) AS ssb, sum(coalesce((n - 1) * v, 0)) AS ssw, any_value(nn) AS nn, any_value(k) AS k FROM g, t)
SELECT CAST(k AS BIGINT) AS k, CAST(nn AS BIGINT) AS n, round(ssb, 4) AS ss_between, round(ssw, 4) AS ss_within,
       round((ssb / (k - 1)) / (ssw / (nn - k)), 6) AS f_stat FROM s""", "features"))
def _prf_anova(spark, sf):
    """PRF-14: one-way ANOVA of fare by passenger count (F; p via ``f_survival``)."""
    a = prf.anova_oneway(v.features(spark, sf), "fare_amount", "passenger_count")
    return a.select("k", "n", rnd("ss_between", 4).alias("ss_between"), rnd("ss_within", 4).alias("ss_within"),
                    rnd("f_stat").alias("f_stat"))


@register("prf_anova_pvalue")
def _prf_anova_p(spark, sf):
    """PRF-14 p-value: F survival function of the aggregate above (driver, one number)."""
    a = prf.anova_oneway(v.features(spark, sf), "fare_amount", "passenger_count").first()
    p = prf.f_survival(a["f_stat"], a["k"] - 1, a["n"] - a["k"])
    return spark.createDataFrame([(float(a["f_stat"]), float(p))], "f_stat double, p_value double")


@register("prf_group_ci", v.with_views("""
SELECT passenger_count, count(fare_amount) AS n, round(avg(fare_amount), 6) AS mean,
       round(stddev_samp(fare_amount) / sqrt(count(fare_amount)), 6) AS sem,
       round(avg(fare_amount) - 1.96 * stddev_samp(fare_amount) / sqrt(count(fare_amount)), 6) AS ci_lo,
       round(avg(fare_amount) + 1.96 * stddev_samp(fare_amount) / sqrt(count(fare_amount)), 6) AS ci_hi
FROM features GROUP BY passenger_count""", "features"))
def _prf_ci(spark, sf):
    """PRF-15: mean fare per passenger count with a 95% interval."""
    g = prf.group_mean_ci(v.features(spark, sf), "fare_amount", ["passenger_count"])
    return g.select("passenger_count", "n", *[rnd(c).alias(c) for c in ("mean", "sem", "ci_lo", "ci_hi")])


CORR_COLS = ("fare_amount", "trip_distance_km", "manhattan_distance_km", "bearing_deg", "passenger_count",
             "pickup_hour", "pickup_dow", "pickup_month", "is_rush_hour", "airport_trip",
             "pickup_dist_from_center_km", "distance_x_rush_hour", "distance_per_passenger")


def _corr_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0), 6) AS r FROM features")
    return v.with_views(" UNION ALL ".join(parts), "features")


@register("prf_correlation", _corr_sql())
def _prf_corr(spark, sf):
    """PRF-16: Pearson r for all 78 pairs of 13 columns in one aggregate."""
    c = prf.correlation_long(v.features(spark, sf), CORR_COLS)
    return c.withColumn("r", rnd("r"))


VIF_COLS = ("trip_distance_km", "manhattan_distance_km", "passenger_count", "pickup_hour", "pickup_dow",
            "pickup_month", "pickup_dist_from_center_km", "distance_per_passenger", "bearing_deg")


@register("prf_vif")
def _prf_vif(spark, sf):
    """PRF-17: variance inflation factors of 9 features."""
    return prf.vif(v.features(spark, sf), VIF_COLS)


@register("prf_monthly", v.with_views("""
SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS n_trips
FROM clean_trips GROUP BY 1, 2""", "clean_trips"))
def _prf_monthly(spark, sf):
    """PRF-18: trips per calendar month."""
    c = v.clean_trips(spark, sf)
    return c.groupBy(F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month")).agg(
        F.count(F.lit(1)).alias("n_trips"))


@register("prf_final_summary", v.with_views("""
SELECT count(*) AS n_rows, epoch_us(min(pickup_datetime)) AS first_pickup_us, epoch_us(max(pickup_datetime)) AS last_pickup_us,
  round(avg(fare_amount), 6) AS mean_fare, round(quantile_cont(fare_amount, 0.5), 6) AS median_fare,
  round(avg(trip_distance_km), 6) AS mean_distance_km, round(100e0 * avg(airport_trip), 6) AS airport_pct,
  round(covar_pop(fare_amount, trip_distance_km) / (stddev_pop(fare_amount) * stddev_pop(trip_distance_km)), 6) AS fare_distance_r
FROM features""", "features"))
def _prf_summary(spark, sf):
    """PRF-19: one-row summary of the cleaned feature table."""
    from ..functions.stats import safe_corr

    f = v.features(spark, sf)
    med = qt.quantile_values(f, ["fare_amount"], [0.5])[((), "fare_amount", 0.5)]
    ts = F.col("pickup_datetime").cast("timestamp")
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.unix_micros(F.min(ts)).alias("first_pickup_us"),
                 F.unix_micros(F.max(ts)).alias("last_pickup_us"), rnd(F.avg("fare_amount")).alias("mean_fare"),
                 rnd(F.lit(med)).alias("median_fare"), rnd(F.avg("trip_distance_km")).alias("mean_distance_km"),
                 rnd(F.lit(100.0) * F.avg("airport_trip")).alias("airport_pct"),
                 rnd(safe_corr("fare_amount", "trip_distance_km")).alias("fare_distance_r"))


@register("geo_grid_density", v.with_views("""
SELECT CAST(floor(pickup_latitude / 0.01e0) AS BIGINT) AS lat_cell, CAST(floor(pickup_longitude / 0.01e0) AS BIGINT) AS lon_cell,
       count(*) AS n_trips, round(avg(least(fare_amount, 60e0)), 6) AS mean_fare_capped
FROM features GROUP BY 1, 2""", "features"))
def _geo_grid(spark, sf):
    """GEO-9: pickup density and mean fare (capped at 60) per 0.01-degree grid cell."""
    f = v.features(spark, sf)
    return f.groupBy(F.floor(F.col("pickup_latitude") / 0.01).cast("bigint").alias("lat_cell"),
                     F.floor(F.col("pickup_longitude") / 0.01).cast("bigint").alias("lon_cell")).agg(
        F.count(F.lit(1)).alias("n_trips"), rnd(F.avg(F.least("fare_amount", F.lit(60.0)))).alias("mean_fare_capped"))
