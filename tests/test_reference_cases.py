"""Unit cases of the operators on small in-line frames."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareline.config import FLAG_AIRPORT, FLAG_NORMAL, FLAG_SURGE
from fareline.operators import features as ft
from fareline.operators import metrics as met
from fareline.operators import models as md
from fareline.operators import prep as pp
from fareline.operators import pricing as prc
from fareline.operators import validate as val

RAW = "fare_amount double, pickup_datetime timestamp, pickup_longitude double, pickup_latitude double, " \
      "dropoff_longitude double, dropoff_latitude double, passenger_count int"


# --- clipper (PP-1) -----------------------------------------------------------

def test_clip_moves_only_values_outside_the_fences(spark):
    xs = [4.0, 5.5, 6.0, 6.5, 7.25, 8.0, -40.0, 90.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    b = pp.fit_clip(df, ["x"])
    q1, q3 = 5.125, 7.4375      # linear quartiles of the eight values
    assert b["x"] == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    out = [r.x for r in pp.apply_clip(df, b).collect()]
    assert out == pytest.approx([max(min(x, b["x"][1]), b["x"][0]) for x in xs])
    assert sum(a != x for a, x in zip(out, xs)) == 2


def test_clip_zero_iqr_means_no_clipping(spark):
    df = spark.createDataFrame([(7.5,)] * 9 + [(-3.0,), (61.0,)], "x double")
    b = pp.fit_clip(df, ["x"])
    assert b["x"] == (None, None)
    assert sorted(r.x for r in pp.apply_clip(df, b).collect())[::10] == [-3.0, 61.0]


def test_clip_idempotent(spark):
    df = spark.createDataFrame([(float(i * i),) for i in range(30)], "x double")
    b = pp.fit_clip(df, ["x"])
    once = pp.apply_clip(df, b)
    twice = pp.apply_clip(once, b)
    assert sorted(once.collect()) == sorted(twice.collect())


# --- feature engineering (GEO / CAL / FT-0) ------------------------------------

def _trips(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_zero_distance(spark):
    t = _trips(spark, [(10.0, datetime(2024, 1, 2, 12), -73.98, 40.75, -73.98, 40.75, 1)])
    f = ft.add_engineered_features(t).first()
    assert f.trip_distance_km == 0.0


def test_drop_off_at_an_airport_against_the_haversine_formula(spark):
    lat1, lon1, lat2, lon2 = (math.radians(x) for x in (40.8075, -73.9626, 40.7769, -73.8740))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    t = _trips(spark, [(31.5, datetime(2024, 3, 5, 9), -73.9626, 40.8075, -73.8740, 40.7769, 1)])
    f = ft.add_engineered_features(t).first()
    assert f.trip_distance_km == pytest.approx(2 * 6371.0088 * math.asin(math.sqrt(h)))
    assert f.near_lga == 1 and f.near_jfk == 0 and f.airport_trip == 1


def test_time_columns_exist_and_new_york_clock(spark):
    # 12:00 UTC on a Monday = 07:00 in New York (EST) -> rush hour
    t = _trips(spark, [(10.0, datetime(2024, 1, 1, 12), -73.98, 40.75, -73.95, 40.77, 2)])
    f = ft.add_engineered_features(t).first()
    for c in ft.FEATURE_COLUMNS:
        assert c in f.asDict()
    assert f.pickup_hour == 7 and f.pickup_dow == 0 and f.is_rush_hour == 1 and f.is_weekend == 0


def test_distance_over_100_km_dropped(spark):
    t = _trips(spark, [(10.0, datetime(2024, 1, 1, 12), -74.5, 40.41, -72.81, 41.19, 1)])
    assert ft.add_engineered_features(t).count() == 0


def test_roles(spark):
    rows = [(float(i), datetime(2024, 1, 1), float(i) * 1.5, i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "fare_amount double, pickup_datetime timestamp, trip_distance_km double, is_weekend int")
    roles = {r.column: r.role for r in pp.detect_roles(df).collect()}
    assert "fare_amount" not in roles and "pickup_datetime" not in roles
    assert roles["is_weekend"] == "binary"
    assert roles["trip_distance_km"] == "continuous"


# --- validation (VAL-*) -------------------------------------------------------------

def test_missing_column_raises(spark):
    df = spark.createDataFrame([(1.0,)], "fare_amount double")
    with pytest.raises(val.ValidationError):
        val.validate_trips(df)


def test_fare_range_and_size_check_before_dedup(spark):
    """The size check counts rows before repeated ones go; fares out of range do not count."""
    row = (17.25, datetime(2024, 2, 9, 18), -73.96, 40.71, -73.99, 40.73, 2)
    other = (23.0,) + row[1:]
    rows = [row] * 350 + [other] * 150 + [(2.49,) + row[1:], (300.01,) + row[1:], (-17.25,) + row[1:]]
    assert val.validate_trips(_trips(spark, rows)).count() == 2
    with pytest.raises(val.ValidationError):
        val.validate_trips(_trips(spark, rows[1:]))     # 499 valid rows


def test_name_normalisation_and_id_drop(spark):
    df = spark.createDataFrame([("k", 1.0)], "` Key `: string, `Fare Amount!`: double")
    out = val.drop_id_columns(val.normalise_columns(df))
    assert out.columns == ["fare_amount_"]


# --- leakage (LKG-*) -------------------------------------------------------------------

def test_leakage(spark):
    import random

    random.seed(0)
    rows = []
    for i in range(500):
        y = random.uniform(5, 50)
        rows.append((y, y, i % 3, random.gauss(0, 1), 1.0001 * y + random.gauss(0, 0.01)))
    df = spark.createDataFrame(rows, "y double, leak_col double, ok_col int, random_col double, almost double")
    r = {x.column: x for x in met.leakage_report(df, "y", ["leak_col", "ok_col", "random_col", "almost"]).collect()}
    assert r["leak_col"].exact_match and r["leak_col"].leak_flag
    assert not r["random_col"].leak_flag
    assert r["almost"].leak_flag and not r["almost"].exact_match


# --- metrics / PSI / cost -------------------------------------------------------------

def _pairs(spark, y, p):
    return spark.createDataFrame(list(zip(map(float, y), map(float, p))), "actual_fare double, predicted_fare double")


def test_small_vector_metrics(spark):
    m = met.regression_metrics(_pairs(spark, [10, 20, 30], [11, 19, 32])).first()
    assert m.mae == pytest.approx(4 / 3)
    m2 = met.regression_metrics(_pairs(spark, [10, 20], [11, 22])).first()
    assert m2.mape == pytest.approx(0.1)
    m3 = met.regression_metrics(_pairs(spark, [10, 10, 10], [10, 11, 20])).first()
    assert m3.within_tol == pytest.approx(2 / 3)


def test_r2_constant_target(spark):
    assert met.regression_metrics(_pairs(spark, [5, 5], [5, 5])).first().r2 == 1.0
    assert met.regression_metrics(_pairs(spark, [5, 5], [4, 6])).first().r2 == 0.0


def test_psi_against_its_formula(spark):
    """Ten equal bins of 0..99; the other side has only values of the lower half."""
    rows = [("expected", float(i)) for i in range(100)] + [("actual", float(i % 50)) for i in range(100)]
    df = spark.createDataFrame(rows, "side string, x double")
    edges = [99 * i / 10 for i in range(11)]
    place = lambda x: max(1, min(sum(e <= x for e in edges), 10))
    share = lambda side: [max(sum(s == side and place(x) == b for s, x in rows) / (100 + 1e-9), 0) or 1e-6 for b in range(1, 11)]
    want = sum((p - q) * math.log(p / q) for p, q in zip(share("expected"), share("actual")))
    assert met.psi(df, "side", ["x"]).first().drift_score == pytest.approx(want)
    same = df.where("side = 'expected'").unionAll(df.where("side = 'expected'").withColumn("side", F.lit("actual")))
    assert met.psi(same, "side", ["x"]).first().drift_score == pytest.approx(0.0, abs=1e-9)


def test_cost_counts(spark):
    c = met.cost_evaluation(_pairs(spark, [10, 10, 10], [8, 12, 10])).first()
    assert c.under_priced_trips == 1 and c.over_priced_trips == 1
    assert c.estimated_revenue_loss == 2.0 and c.estimated_trust_cost == 0.7
    assert c.total_estimated_cost == 2.7 and c.avg_cost_per_trip == 0.9


# --- pricing (PRC-*) -------------------------------------------------------------------

def test_bands_clamps_flags(spark):
    df = spark.createDataFrame(
        [(5.0, 0, 0, 1.0), (150.0, 0, 1, 6.0), (1.0, 1, 1, 9.0), (1000.0, 0, 1, 3.0)],
        "predicted_fare double, airport_trip int, is_rush_hour int, trip_distance_km double")
    out = prc.price_trips(df).collect()
    assert [r.fare_band for r in out] == ["LOW", "PREMIUM", "LOW", "PREMIUM"]
    assert [r.clamped_fare for r in out] == [5.0, 150.0, 2.5, 300.0]
    assert [r.pricing_flag for r in out] == [FLAG_NORMAL, FLAG_SURGE, FLAG_AIRPORT, FLAG_NORMAL]


def test_score_trip_interval_and_none_flag(spark):
    df = spark.createDataFrame([(20.004, 0, 0, 1.0, 15.123, 25.456)],
                               "predicted_fare double, airport_trip int, is_rush_hour int, trip_distance_km double, "
                               "lo double, hi double")
    r = df.select(*[c.alias(k) for k, c in prc.score_columns("predicted_fare", "lo", "hi").items()]).first()
    assert r.predicted_fare_usd == 20.0 and r.fare_band == "MEDIUM" and r.pricing_flag is None
    assert (r.interval_lo, r.interval_hi) == (15.12, 25.46)


def test_band_range_join_matches_when_chain(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 9.99, 10.0, 29.9, 30.0, 70.0, 20000.0)], "p double")
    a = sorted((r.p, r.fare_band) for r in df.select("p", prc.fare_band("p").alias("fare_band")).collect())
    b = sorted((r.p, r.fare_band) for r in prc.band_by_range_join(df, "p", prc.band_table(spark)).collect())
    assert a == b


# --- model selection (MOD-8) -----------------------------------------------------------

SUMMARY = ("model string, train_r2 double, test_r2 double, train_test_gap double, cv_mean_rmse double, "
           "cv_std_rmse double, test_rmse double, test_mae double, test_mape double, adjusted_r2 double, "
           "within_15pct_acc double")


def test_select_single_candidate(spark):
    s = spark.createDataFrame([("Only", 0.9, 0.89, 0.01, 4.0, 0.1, 4.0, 2.0, 0.2, 0.88, 0.5)], SUMMARY)
    assert md.select_best(s).first().model == "Only"


def test_select_prefers_tier_over_rmse(spark):
    s = spark.createDataFrame([
        ("Overfit", 0.99, 0.80, 0.19, 3.0, 0.1, 3.0, 1.0, 0.1, 0.8, 0.6),
        ("Stable", 0.91, 0.905, 0.005, 3.5, 0.1, 3.5, 1.5, 0.1, 0.9, 0.5),
    ], SUMMARY)
    assert md.select_best(s).first().model == "Stable"


def test_missing_flag_inputs_count_as_zero(spark):
    df = spark.createDataFrame([(12.0,)], "predicted_fare double")
    r = prc.price_trips(df).first()
    assert r.pricing_flag == FLAG_NORMAL and r.fare_band == "MEDIUM"


# --- preprocessing (PP-6) and config ------------------------------------------

def test_preprocessor_keeps_rows_and_encodes_text_ordinals(spark):
    rows = [("b", float(i), i % 2) for i in range(40)] + [("a", 100.0 + i, 1) for i in range(30)] + \
           [("c", -5.0, 0) for _ in range(30)]
    df = spark.createDataFrame(rows, "cat string, x double, flag int")
    model = md.TripPreprocessor(ordinalCols=["cat"], continuousCols=["x"], binaryCols=["flag"]).fit(df)
    out = model.transform(df)
    assert out.count() == df.count()
    vecs = {r.cat: r.features.toArray() for r in out.select("cat", "features").collect()}
    assert all(len(v) == 3 for v in vecs.values())
    assert {k: v[0] for k, v in vecs.items()} == {"a": 0.0, "b": 1.0, "c": 2.0}
    unseen = spark.createDataFrame([("z", 1.0, 0)], "cat string, x double, flag int")
    assert model.transform(unseen).first().features[0] == -1.0
    assert min(12, len(["cat", "x", "flag"])) <= 3   # k = min(12, #features)


def test_config_thresholds_ordered():
    from fareline import config as cf

    assert cf.PSI_MODERATE < cf.PSI_HIGH
    r = cf.DEFAULT_RULES
    assert r.min_fare < r.max_fare and r.min_passengers <= r.max_passengers
    assert r.min_lat < r.max_lat and r.min_lon < r.max_lon
    bands = cf.FARE_BANDS
    assert all(lo < hi for _, lo, hi in bands)
    assert all(bands[i][2] == bands[i + 1][1] for i in range(len(bands) - 1))
    tiers = cf.SELECTION_TIERS
    assert all(a[0] <= b[0] and a[1] <= b[1] and a[2] >= b[2] for a, b in zip(tiers, tiers[1:]))
    assert 0 < cf.MIN_RMSE_IMPROVEMENT < 1 and 0 < cf.MIN_R2 < 1 and 0 < cf.MAX_GAP < 1
