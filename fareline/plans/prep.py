"""Queries for roles, preprocessing fits / transforms, selection and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import SELECT_K
from ..operators import prep as pp
from ..operators.knn_mi import knn_mutual_information
from ..operators.features import FEATURE_COLUMNS
from . import register
from . import views as v
from .common import rnd
from .monitoring import HASH_SQL

CONT = ("trip_distance_km", "manhattan_distance_km", "pickup_dist_from_center_km", "distance_per_passenger",
        "distance_x_rush_hour", "bearing_deg")
TRAIN_SQL = f", tr AS (SELECT * FROM features WHERE {HASH_SQL} < 64)"


def _train(spark, sf):
    f = v.features(spark, sf)
    return f.where(pp.hash_bucket() < 64)


ROLE_COLS = ("event_type", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
             "passenger_count", "trip_distance_km", "manhattan_distance_km", "bearing_deg", "pickup_hour", "pickup_dow",
             "pickup_month", "is_weekend", "is_rush_hour", "is_late_night", "hour_sin", "hour_cos", "dow_sin",
             "dow_cos", "near_jfk", "near_lga", "near_ewr", "airport_trip", "pickup_dist_from_center_km",
             "distance_x_rush_hour", "distance_per_passenger")


def _roles_sql():
    parts = []
    for c in ROLE_COLS:
        n = f"(count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)))"
        role = ("'ordinal'" if c == "event_type" else
                f"CASE WHEN {n} = 2 THEN 'binary' WHEN {n} BETWEEN 3 AND 10 THEN 'ordinal' ELSE 'continuous' END")
        parts.append(f"SELECT '{c}' AS \"column\", CAST({n} AS BIGINT) AS n_unique, {role} AS role FROM features")
    return v.with_views(" UNION ALL ".join(parts), "features")


@register("ft_roles", _roles_sql())
def _roles(spark, sf):
    """FT-1: binary / ordinal / continuous role of every feature column."""
    f = v.features(spark, sf).select(*ROLE_COLS)
    return pp.detect_roles(f)


@register("pp_clip_fit", v.with_views(TRAIN_SQL + ", q AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM tr" for c in CONT) + """)
SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3,
  CASE WHEN q3 - q1 = 0 THEN NULL ELSE round(q1 - 1.5 * (q3 - q1), 6) END AS lower,
  CASE WHEN q3 - q1 = 0 THEN NULL ELSE round(q3 + 1.5 * (q3 - q1), 6) END AS upper FROM q""", "features"))
def _clip_fit(spark, sf):
    """PP-1 fit: IQR clip bounds on the train split (IQR 0 -> no clipping)."""
    from ..operators import quantiles as qt

    tr = _train(spark, sf)
    q = qt.quantile_values(tr, CONT, [0.25, 0.75])
    rows = []
    for c in CONT:
        q1, q3 = q[((), c, 0.25)], q[((), c, 0.75)]
        lo, hi = (None, None) if q3 - q1 == 0 else (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        rows.append((c, q1, q3, lo, hi))
    df = spark.createDataFrame(rows, "feature string, q1 double, q3 double, lower double, upper double")
    return df.select("feature", *[rnd(c).alias(c) for c in ("q1", "q3", "lower", "upper")])


@register("pp_clip_apply", v.with_views(TRAIN_SQL + ", q AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM tr" for c in CONT) + """),
b AS (SELECT feature, CASE WHEN q3 - q1 = 0 THEN NULL ELSE q1 - 1.5 * (q3 - q1) END AS lo,
             CASE WHEN q3 - q1 = 0 THEN NULL ELSE q3 + 1.5 * (q3 - q1) END AS hi FROM q),
l AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x FROM features" for c in CONT) + """)
SELECT l.feature, count(*) FILTER (WHERE x < lo) AS n_low, count(*) FILTER (WHERE x > hi) AS n_high,
  round(avg(CASE WHEN lo IS NULL THEN x ELSE greatest(least(x, hi), lo) END), 6) AS mean_clipped
FROM l JOIN b ON l.feature = b.feature GROUP BY l.feature""", "features"))
def _clip_apply(spark, sf):
    """PP-1 transform: train-fitted bounds applied to every row; clipped counts and mean."""
    tr = _train(spark, sf)
    bounds = pp.fit_clip(tr, CONT)
    f = v.features(spark, sf)
    clipped = pp.apply_clip(f.select(*CONT), bounds)
    aggs = []
    for c in CONT:
        lo, hi = bounds[c]
        aggs += [F.count_if(F.col(c) < lo).alias(f"{c}__l") if lo is not None else F.lit(0).cast("bigint").alias(f"{c}__l"),
                 F.count_if(F.col(c) > hi).alias(f"{c}__h") if hi is not None else F.lit(0).cast("bigint").alias(f"{c}__h")]
    counts = f.agg(*aggs)
    means = clipped.agg(*[F.avg(c).alias(f"{c}__m") for c in CONT])
    j = counts.crossJoin(means)
    return j.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__l").alias("n_low"),
                                                F.col(f"{c}__h").alias("n_high"), rnd(f"{c}__m").alias("mean_clipped"))
                                       for c in CONT])))


SKEW_COLS = ("fare_amount", "trip_distance_km", "manhattan_distance_km", "pickup_dist_from_center_km",
             "distance_per_passenger", "bearing_deg", "pickup_latitude")


@register("pp_skew_split", v.with_views(TRAIN_SQL + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(skewness({c}), 6) AS skew, "
    f"{'false' if c in ('bearing_deg', 'pickup_latitude') else f'abs(skewness({c})) > 0.8'} AS skewed FROM tr"
    for c in SKEW_COLS), "features"))
def _skew(spark, sf):
    """PP-2: bias-corrected skewness and the skewed / not-skewed split (GPS and bearing never skewed)."""
    skewed, _, sk = pp.skew_split(_train(spark, sf), SKEW_COLS)
    rows = [(c, sk[c], c in skewed) for c in SKEW_COLS]
    return spark.createDataFrame(rows, "feature string, skew double, skewed boolean").withColumn("skew", rnd("skew"))


YJ_COLS = ("fare_amount", "trip_distance_km")
YJ_GRID = tuple(round(-2 + 0.2 * i, 10) for i in range(21))


def _yj_sql(c, lam):
    pos = f"ln(1 + {c})" if lam == 0 else f"(pow({c} + 1, {lam!r}e0) - 1) / {lam!r}e0"
    neg = f"-ln(1 - {c})" if lam == 2 else f"-(pow(1 - {c}, {2 - lam!r}e0) - 1) / {2 - lam!r}e0"
    return f"CASE WHEN {c} >= 0 THEN {pos} ELSE {neg} END"


@register("pp_yeo_johnson_ll", v.with_views(TRAIN_SQL + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {lam!r}e0 AS lambda, round(-count({c}) / 2 * ln(var_pop({_yj_sql(c, lam)})) "
    f"+ ({lam!r}e0 - 1) * sum(sign({c}) * ln(1 + abs({c}))), 4) AS ll FROM tr"
    for c in YJ_COLS for lam in YJ_GRID), "features"))
def _yj_ll(spark, sf):
    """PP-3: Yeo-Johnson log-likelihood on a 21-point lambda grid, one aggregate."""
    g = pp.yj_loglik_grid(_train(spark, sf), YJ_COLS, YJ_GRID)
    return g.select("feature", "lambda", rnd("ll", 4).alias("ll"))


@register("pp_yeo_johnson_apply", v.with_views(TRAIN_SQL + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({_yj_sql(c, 0.5)}), 6) AS mean, round(stddev_pop({_yj_sql(c, 0.5)}), 6) AS std FROM tr"
    for c in YJ_COLS), "features"))
def _yj_apply(spark, sf):
    """PP-3 transform with a fixed lambda (0.5): mean and population std of the output."""
    tr = _train(spark, sf)
    a = tr.agg(*[F.avg(pp.yeo_johnson(c, 0.5)).alias(f"{c}__m") for c in YJ_COLS],
               *[F.stddev_pop(pp.yeo_johnson(c, 0.5)).alias(f"{c}__s") for c in YJ_COLS])
    return a.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), rnd(f"{c}__m").alias("mean"),
                                                rnd(f"{c}__s").alias("std")) for c in YJ_COLS])))


@register("pp_yeo_johnson_fit")
def _yj_fit(spark, sf):
    """PP-3 fit: maximum-likelihood lambda per skewed column (grid zoom, one aggregate per round)."""
    lam = pp.fit_yeo_johnson(_train(spark, sf), YJ_COLS)
    return spark.createDataFrame([(c, float(x)) for c, x in lam.items()], "feature string, lambda double")


STD_COLS = ("trip_distance_km", "pickup_hour", "pickup_latitude", "is_rush_hour")


@register("pp_standardise", v.with_views(TRAIN_SQL + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, "
    f"round((min({c}) - avg({c})) / CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS scaled_min, "
    f"round((max({c}) - avg({c})) / CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS scaled_max FROM tr"
    for c in STD_COLS), "features"))
def _std(spark, sf):
    """PP-4: population-std standardisation fitted on train (zero std -> divide by 1)."""
    tr = _train(spark, sf)
    prm = pp.fit_standard(tr, STD_COLS)
    a = tr.agg(*[F.min(pp.standard_expr(c, prm[c])).alias(f"{c}__lo") for c in STD_COLS],
               *[F.max(pp.standard_expr(c, prm[c])).alias(f"{c}__hi") for c in STD_COLS])
    return a.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("feature"), rnd(F.lit(prm[c][0])).alias("mean"), rnd(F.lit(prm[c][1])).alias("std"),
        rnd(f"{c}__lo").alias("scaled_min"), rnd(f"{c}__hi").alias("scaled_max")) for c in STD_COLS])))


ORD_COLS = ("passenger_count", "pickup_dow", "event_type")


@register("pp_ordinal_dictionary", v.with_views(TRAIN_SQL + """
, d AS (SELECT DISTINCT 'passenger_count' AS feature, CAST(passenger_count AS DOUBLE) AS num_value, CAST(NULL AS VARCHAR) AS str_value FROM tr
  UNION ALL SELECT DISTINCT 'pickup_dow', CAST(pickup_dow AS DOUBLE), NULL FROM tr
  UNION ALL SELECT DISTINCT 'event_type', NULL, event_type FROM tr)
SELECT feature, num_value, str_value, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY num_value, str_value) - 1 AS INTEGER) AS code FROM d""",
                                                 "features"))
def _ord_dict(spark, sf):
    """PP-5 fit: sorted distinct value -> code dictionary (numeric order)."""
    return pp.fit_ordinal(_train(spark, sf), ORD_COLS)


@register("pp_ordinal_apply", v.with_views(TRAIN_SQL + f"""
, te AS (SELECT * FROM features WHERE {HASH_SQL} >= 80),
d AS (SELECT DISTINCT passenger_count AS v FROM tr WHERE passenger_count < 6),
c AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM d)
SELECT coalesce(c.code, -1) AS passenger_count_code, count(*) AS n FROM te LEFT JOIN c ON te.passenger_count = c.v GROUP BY 1""",
                                            "features"))
def _ord_apply(spark, sf):
    """PP-5 transform: test rows encoded with a train dictionary that lacks 6 passengers -> -1."""
    tr = _train(spark, sf).where(F.col("passenger_count") < 6)
    d = pp.fit_ordinal(tr, ["passenger_count"])
    te = v.features(spark, sf).where(pp.hash_bucket() >= 80)
    enc = pp.apply_ordinal(te, d, ["passenger_count"])
    return enc.groupBy("passenger_count_code").agg(F.count(F.lit(1)).alias("n"))


MI_COLS = ("passenger_count", *FEATURE_COLUMNS)
_MI_PROBS = "[" + ", ".join(repr(i / 20) for i in range(1, 20)) + "]"


MI_SQL = v.with_views(TRAIN_SQL + ", e AS (SELECT " + ", ".join(
    f"list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), {_MI_PROBS}))) AS e_{c}" for c in MI_COLS + ("fare_amount",))
    + " FROM tr),\nl AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, len(list_filter(e_{c}, lambda q: q <= CAST({c} AS DOUBLE))) AS bin_x, "
    f"len(list_filter(e_fare_amount, lambda q: q <= fare_amount)) AS bin_y FROM tr, e" for c in MI_COLS) + """),
c AS (SELECT feature, bin_x, bin_y, count(*) AS c FROM l GROUP BY 1, 2, 3),
p AS (SELECT feature, c / sum(c) OVER (PARTITION BY feature) AS pxy,
        sum(c) OVER (PARTITION BY feature, bin_x) / sum(c) OVER (PARTITION BY feature) AS px,
        sum(c) OVER (PARTITION BY feature, bin_y) / sum(c) OVER (PARTITION BY feature) AS py FROM c)
SELECT feature, round(sum(pxy * ln(pxy / (px * py))), 6) AS mi FROM p GROUP BY feature""", "features")
TOP_K = SELECT_K


@register("sel_mutual_information", MI_SQL)
def _mi(spark, sf):
    """SEL-1: binned (20 quantile bins) mutual information of each feature with the fare, train split."""
    m = pp.binned_mutual_information(_train(spark, sf), MI_COLS, "fare_amount")
    return m.withColumn("mi", rnd("mi"))


@register("sel_top_k", MI_SQL + f" ORDER BY mi DESC, feature LIMIT {TOP_K}")
def _topk(spark, sf):
    """SEL-1/SEL-2: the 12 of all features with the highest MI (the selection mask)."""
    m = pp.binned_mutual_information(_train(spark, sf), MI_COLS, "fare_amount")
    return m.withColumn("mi", rnd("mi")).orderBy(F.desc("mi"), "feature").limit(TOP_K)


# all pairs of rows; psi of a whole number by the harmonic sums
_KNN_SQL = v.with_views(f"""
, tr AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM features WHERE {HASH_SQL} < 64),
long AS MATERIALIZED ({" UNION ALL ".join(f"SELECT '{c}' AS feature, rid, CAST({c} AS DOUBLE) AS v, fare_amount AS y FROM tr" for c in MI_COLS)}),
sc AS (SELECT feature, stddev_pop(v) AS sx, stddev_pop(y) AS sy, count(*) AS n FROM long GROUP BY feature),
r AS MATERIALIZED (
  SELECT a.feature, a.rid, any_value(a.v) AS v, any_value(a.y) AS y, any_value(n) AS n, any_value(sx) AS sx, any_value(sy) AS sy,
    min(greatest(abs(a.v - b.v) / CASE WHEN sx > 0 THEN sx ELSE 1 END, abs(a.y - b.y) / CASE WHEN sy > 0 THEN sy ELSE 1 END), 3)[3] AS r
  FROM long a JOIN long b ON a.feature = b.feature AND a.rid <> b.rid JOIN sc ON sc.feature = a.feature GROUP BY a.feature, a.rid),
near AS (
  SELECT r.feature, r.rid, any_value(r.n) AS n,
    count(*) FILTER (abs(r.v - b.v) / CASE WHEN sx > 0 THEN sx ELSE 1 END < r.r OR (r.r = 0 AND r.v = b.v)) AS nx,
    count(*) FILTER (abs(r.y - b.y) / CASE WHEN sy > 0 THEN sy ELSE 1 END < r.r OR (r.r = 0 AND r.y = b.y)) AS ny
  FROM r JOIN long b ON b.feature = r.feature GROUP BY r.feature, r.rid),
psi AS (SELECT i, sum(CASE WHEN i > 1 THEN 1e0 / (i - 1) ELSE 0 END) OVER (ORDER BY i) - 0.5772156649015329e0 AS p
  FROM range(1, (SELECT max(n) + 1 FROM sc)) t(i))
SELECT feature, round(greatest(any_value(pn.p) + 1.5e0 - 0.5772156649015329e0 - avg(px.p + py.p), 0), 6) AS mi
FROM near JOIN psi px ON px.i = nx JOIN psi py ON py.i = ny JOIN psi pn ON pn.i = n GROUP BY feature""", "features")


@register("sel_knn_mutual_information", _KNN_SQL)
def _knn_mi(spark, sf):
    """SEL-1: nearest-neighbour (k = 3) mutual information of each feature with the fare, all rows of the train split."""
    m = knn_mutual_information(_train(spark, sf), MI_COLS, "fare_amount")
    return m.withColumn("mi", rnd("mi"))


SPLIT_SQL = v.with_views(f"""
SELECT CASE WHEN {HASH_SQL} < 64 THEN 'train' WHEN {HASH_SQL} < 80 THEN 'calibration' ELSE 'test' END AS split, count(*) AS n
FROM clean_trips GROUP BY 1""", "clean_trips")


@register("spl_hash_split", SPLIT_SQL)
def _spl(spark, sf):
    """SPL-1: 64 / 16 / 20 train / calibration / test by a stable key hash."""
    return v.clean_trips(spark, sf).groupBy(pp.split_label().alias("split")).agg(F.count(F.lit(1)).alias("n"))


@register("spl_kfold", v.with_views(" UNION ALL ".join(
    f"SELECT {r} AS rep, CAST(('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), '{s}')), 1, 8))::BIGINT % 5 AS INTEGER) AS fold, count(*) AS n FROM clean_trips GROUP BY 1, 2"
    for r, s in ((0, "42"), (1, "43"), (2, "44"))), "clean_trips"))
def _kfold(spark, sf):
    """SPL-3: 5-fold assignment, repeated with 3 seeds (fold sizes)."""
    c = v.clean_trips(spark, sf)
    parts = [c.groupBy(F.lit(r).alias("rep"), pp.kfold(seed=s).alias("fold")).agg(F.count(F.lit(1)).alias("n"))
             for r, s in ((0, "42"), (1, "43"), (2, "44"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_CUT_SQL = """
, o AS (SELECT pickup_datetime AS ts, row_number() OVER (ORDER BY pickup_datetime) - 1 AS rk, count(*) OVER () AS n FROM clean_trips),
cut AS (SELECT {f} AS frac, (SELECT ts FROM o WHERE rk = least(CAST(floor({f} * n) AS BIGINT), n - 1) LIMIT 1) AS ts FROM o LIMIT 1)"""


@register("spl_time_split", v.with_views(_CUT_SQL.format(f="0.85") + """
SELECT epoch_us(cut.ts) AS cutoff_us, count(*) FILTER (WHERE c.pickup_datetime <= cut.ts) AS n_train,
       count(*) FILTER (WHERE c.pickup_datetime > cut.ts) AS n_test
FROM clean_trips c, cut GROUP BY cut.ts""", "clean_trips"))
def _time_split(spark, sf):
    """SPL-2: cutoff = sorted(ts)[int(0.85 n)]; train = ts <= cutoff (exact, distributed)."""
    c = v.clean_trips(spark, sf)
    cut = pp.time_cutoffs(c, "pickup_datetime", [0.85])[0.85]
    us = F.unix_micros(F.col("pickup_datetime").cast("timestamp"))
    return c.agg(F.lit(cut).cast("bigint").alias("cutoff_us"), F.count_if(us <= cut).alias("n_train"),
                 F.count_if(us > cut).alias("n_test"))


@register("spl_rolling_folds", v.with_views("""
, o AS (SELECT pickup_datetime AS ts, row_number() OVER (ORDER BY pickup_datetime) - 1 AS rk, count(*) OVER () AS n FROM clean_trips),
b AS (SELECT f.i, f.frac, (SELECT ts FROM o WHERE rk = least(CAST(floor(f.frac * o2.n) AS BIGINT), o2.n - 1) LIMIT 1) AS ts
      FROM (VALUES (0, 0.55), (1, 0.70), (2, 0.85), (3, 1.0)) f(i, frac), (SELECT max(n) AS n FROM o) o2),
folds AS (SELECT b1.i AS fold, b1.ts AS lo, b2.ts AS hi FROM b b1 JOIN b b2 ON b2.i = b1.i + 1)
SELECT fold, count(*) FILTER (WHERE c.pickup_datetime <= lo) AS n_train,
       count(*) FILTER (WHERE c.pickup_datetime > lo AND c.pickup_datetime <= hi) AS n_test
FROM folds, clean_trips c GROUP BY fold""", "clean_trips"))
def _rolling(spark, sf):
    """SPL-4: rolling-origin folds: expanding train window, the next ~15% as test."""
    c = v.clean_trips(spark, sf)
    fr = [0.55, 0.70, 0.85, 1.0]
    cuts = pp.time_cutoffs(c, "pickup_datetime", fr)
    us = F.unix_micros(F.col("pickup_datetime").cast("timestamp"))
    # fold bounds are driver-side numbers: one pass of conditional counts, no join
    aggs = []
    for i in range(3):
        lo, hi = cuts[fr[i]], cuts[fr[i + 1]]
        aggs += [F.count_if(us <= lo).alias(f"tr{i}"), F.count_if((us > lo) & (us <= hi)).alias(f"te{i}")]
    a = c.agg(*aggs)
    return a.select(F.inline(F.array(*[F.struct(F.lit(i).alias("fold"), F.col(f"tr{i}").alias("n_train"),
                                                F.col(f"te{i}").alias("n_test")) for i in range(3)])))
