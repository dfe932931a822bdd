"""Engine-level properties: exact quantiles, rounding, gate replay, splits, entry."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.functions.stats import round_half_even_exact
from fareline.operators import monitor as mon
from fareline.operators import prep as pp
from fareline.operators import profile as prf
from fareline.operators import quantiles as qt


@pytest.mark.parametrize("kind", ["uniform", "heavy_duplicates", "skewed_group"])
def test_exact_quantiles_match_numpy(spark, kind):
    rng = random.Random(7)
    if kind == "uniform":
        rows = [("a", rng.uniform(-5, 5)) for _ in range(30000)]
    elif kind == "heavy_duplicates":
        # a third of all rows hold one value
        rows = [("a", 3.25)] * 12000 + [("a", rng.expovariate(0.5)) for _ in range(24000)]
    else:
        rows = [("hot", rng.gauss(0, 1)) for _ in range(25000)] + [("cold", rng.gauss(5, 2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = qt.quantile_values(df, ["x"], probs, ["g"])
    for g in {r[0] for r in rows}:
        xs = np.array([r[1] for r in rows if r[0] == g])
        for p in probs:
            assert got[((g,), "x", p)] == pytest.approx(float(np.quantile(xs, p)), rel=0, abs=1e-12)


def test_order_statistic(spark):
    xs = [float(i % 97) for i in range(1000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = qt.order_statistic_values(df, "x", [0.85])
    assert got[((), 0.85)] == sorted(xs)[int(0.85 * len(xs))]


def test_round_half_even_matches_python(spark):
    rng = random.Random(3)
    vals = [147.575, 16.905000000000001, 0.125, 2.675, -2.675] + [round(rng.uniform(0, 500), 3) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", round_half_even_exact("x", 2).alias("r")).collect():
        assert r.r == round(r.x, 2)


def test_gate_reproduces_reference_log(spark):
    # (seq, name, rmse, r2, gap, champion_rmse, recorded decision) - values of the reference's promotion log
    runs = [
        (1, "NeuralNet", 3.5624, 0.9647, None, None, "PROMOTED"),
        (2, "LightGBM", 3.8694, 0.8375, 0.0227, 3.5624, "REJECTED"),
        (3, "LightGBM", 3.8850, 0.8339, 0.0212, 3.5624, "REJECTED"),
        (4, "LightGBM", 3.8850, 0.8339, None, None, "PROMOTED"),
        (5, "LightGBM", 3.8015, 0.8419, 0.0044, 3.8850, "PROMOTED"),
        (6, "LightGBM", 3.8067, 0.8419, 0.0039, 3.8015, "REJECTED"),
        (7, "LightGBM", 3.8067, 0.8419, 0.0039, 3.8015, "REJECTED"),
        (8, "LightGBM", 3.8067, 0.8419, 0.0039, 3.8015, "REJECTED"),
    ]
    df = spark.createDataFrame(runs, "seq int, name string, challenger_rmse double, challenger_r2 double, "
                                     "challenger_gap double, champion_rmse double, recorded string")
    out = mon.apply_gate(df).collect()
    assert all(r.decision == r.recorded for r in out)
    r6 = [r for r in out if r.seq == 6][0]
    assert r6.reason.startswith("Gates failed: RMSE improvement")


def test_replay_matches_sequential_loop_beyond_recursion_limit(spark):
    from fareline.plans.monitoring import replay

    rng = random.Random(5)
    runs, rmse = [], 10.0
    for s in range(1, 301):
        rmse = max(0.5, rmse + rng.uniform(-0.4, 0.3))
        runs.append((s, rmse, rng.choice([0.75, 0.85, 0.95, None]), rng.choice([0.05, 0.2])))
    champ, want = None, {}
    for s, rm, r2, gap in runs:   # brute force: the gate applied run by run
        if champ is None:
            want[s] = (None, "PROMOTED")
            champ = rm
            continue
        ok = (champ - rm) / max(champ, 1e-9) >= 0.02 and r2 is not None and r2 >= 0.80 and gap <= 0.15
        want[s] = (champ, "PROMOTED" if ok else "REJECTED")
        champ = rm if ok else champ
    df = spark.createDataFrame(runs, "seq bigint, rmse double, r2 double, gap double")
    got = {r.seq: (r.champion_rmse, r.decision) for r in replay(spark, df).collect()}
    assert got == want
    assert sum(d == "PROMOTED" for _, d in want.values()) > 3


def test_hash_split_disjoint_and_complete(spark):
    df = spark.range(5000).withColumnRenamed("id", "event_id")
    s = df.withColumn("split", pp.split_label())
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000 and set(counts) == {"train", "calibration", "test"}
    assert 0.60 < counts["train"] / 5000 < 0.68


def test_f_survival():
    # F(2, 10) upper tail at 4.1028 is 0.05 (table value)
    assert prf.f_survival(4.1028, 2, 10) == pytest.approx(0.05, abs=2e-4)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"pickup_hour", "n_trips", "mean_fare", "median_fare"}


def test_every_oracle_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_sample_n_equals_topk(spark):
    from fareline.functions.stats import hash_unit

    df = spark.range(20000).withColumnRenamed("id", "event_id")
    got = sorted(r.event_id for r in pp.sample_n(df, 1500).collect())
    want = sorted(r.event_id for r in df.orderBy(hash_unit("event_id"), "event_id").limit(1500).collect())
    assert got == want


def test_calibration_is_one_path_at_any_row_count(spark):
    from fareline.operators import models as md

    rng = random.Random(5)
    rows = []
    for _ in range(4000):
        p = rng.uniform(5, 60)
        rows.append((p + rng.gauss(0, 0.1 * p), p))
    df = spark.createDataFrame(rows, "fare_amount double, prediction double")
    _iso, cal = md.calibrate(df)
    assert 0.88 <= cal.empirical_coverage <= 0.92
    more = df
    for _ in range(3):
        more = more.unionAll(more)
    _iso2, again = md.calibrate(more)      # eight times the rows: the same fit, the same k up to interpolation
    assert again.k == pytest.approx(cal.k, rel=2e-3)
    assert _iso2.x == pytest.approx(_iso.x) and _iso2.y == pytest.approx(_iso.y)


def test_preprocessor_stage_fit_save_load(spark):
    import os
    import uuid

    from pyspark.ml import Pipeline, PipelineModel

    from fareline.operators import models as md

    rng = random.Random(9)
    rows = [(rng.expovariate(0.3), rng.randint(1, 6), rng.randint(0, 1), rng.uniform(5, 60)) for _ in range(400)]
    df = spark.createDataFrame(rows, "dist double, pax int, rush int, fare_amount double")
    stage = md.TripPreprocessor(ordinalCols=["pax"], continuousCols=["dist"], binaryCols=["rush"], scaled=True)
    model = Pipeline(stages=[stage, md.make_regressor("linear")]).fit(df)
    path = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"test-model-{uuid.uuid4().hex[:8]}")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = sorted(r.prediction for r in model.transform(df).collect())
    b = sorted(r.prediction for r in loaded.transform(df).collect())
    assert a == pytest.approx(b)


def test_business_dedup_survivor_is_min(spark):
    from fareline.operators import validate as val

    rows = [(1, "a", 3), (1, "a", 1), (1, "a", 2), (2, "b", 5)]
    df = spark.createDataFrame(rows, "k int, s string, o int")
    out = sorted(tuple(r) for r in val.drop_business_duplicates(df, ["k", "s"], "o").collect())
    assert out == [(1, "a", 1), (2, "b", 5)]


def test_shuffled_columns_keep_the_multiset(spark):
    from fareline.operators import models as md

    df = spark.createDataFrame([(i, float(i % 7), i * 2.0) for i in range(3000)], "event_id long, x double, y double")
    p = md.shuffled_columns(df, ["x", "y"], seed=1, rows_per_block=500)
    rows, src = p.collect(), df.collect()
    assert len(rows) == 3000
    for c in ("x", "y"):
        assert sorted(r[f"_s_{c}"] for r in rows) == sorted(r[c] for r in src)
        assert sum(r[f"_s_{c}"] != r[c] for r in rows) > 1000
    # same draws whatever the partitioning (a recomputed partition sees the same permutation)
    again = md.shuffled_columns(df.repartition(5, "y"), ["x", "y"], seed=1, rows_per_block=500)
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("bracket", [0.0, 1e-6, 0.2])
def test_quantiles_exact_whatever_the_sketch_bracket(spark, monkeypatch, bracket):
    monkeypatch.setattr(qt, "BRACKET", bracket)
    monkeypatch.setattr(qt, "COLLECT_LIMIT", 500)
    rng = random.Random(11)
    xs = [rng.lognormvariate(0, 1) for _ in range(6000)] + [2.0] * 3000
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    probs = [0.0, 0.05, 0.33, 0.5, 0.9, 0.999, 1.0]
    got = qt.quantile_values(df, ["x"], probs)
    for p in probs:
        assert got[((), "x", p)] == pytest.approx(float(np.quantile(np.array(xs), p)), abs=1e-12)


# --- cases with NaN, odd types, collinear columns, empty columns ----------------------------------

def test_leakage_ignores_nan_and_odd_types(spark):
    from fareline.operators import metrics as met

    rng = random.Random(2)
    rows = [(rng.uniform(3, 300), rng.random() if i else float("nan"), i % 5, rng.random() < 0.5, "a") for i in range(200)]
    df = spark.createDataFrame(rows, "y double, x double, t int, b boolean, s string").selectExpr(
        "y", "x", "CAST(t AS TINYINT) AS t", "b", "s", "timestamp'2024-01-01' AS ts", "y AS leak")
    flags = {r["column"]: r["leak_flag"] for r in met.leakage_report(df, "y", ["x", "t", "b", "s", "ts", "leak"]).collect()}
    assert flags == {"x": False, "t": False, "b": False, "s": False, "ts": False, "leak": True}


def test_vif_of_collinear_and_constant_columns(spark):
    rng = random.Random(4)
    rows = [(a := rng.gauss(0, 1), a, rng.gauss(0, 1), 5.0, a + rng.gauss(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, same double, free double, const double, near double")
    got = {r["feature"]: r["vif"] for r in prf.vif(df, ["a", "same", "free", "const", "near"]).collect()}
    assert got["a"] == got["same"] == float("inf") and got["const"] is None and 1 <= got["free"] < 1.1
    got = {r["feature"]: r["vif"] for r in prf.vif(df, ["a", "free", "near"]).collect()}
    x = np.array(rows)[:, [0, 2, 4]]
    want = np.diag(np.linalg.inv(np.corrcoef(x.T)))
    assert [got[c] for c in ("a", "free", "near")] == pytest.approx(list(want), rel=1e-9)


def test_nan_is_skipped_everywhere(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(float("nan"),), (None,)], "x double")
    r = prf.describe(df, ["x"]).first()
    assert (r["count"], r["mean"], r["max"], r["q50"]) == (10, 5.5, 10.0, 5.5)
    assert pp.fit_standard(df, ["x"])["x"] == pytest.approx((5.5, np.std(np.arange(1, 11))))
    assert math.isfinite(pp.skew_split(df, ["x"])[2]["x"])


def test_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    assert qt.quantile_values(df, ["x", "y"], [0.5]) == {((), "x", 0.5): None, ((), "y", 0.5): 1.5}
    assert pp.fit_clip(df, ["x"]) == {"x": (None, None)}
    assert qt.quantile_values(df.limit(0), ["y"], [0.5]) == {((), "y", 0.5): None}


def test_yeo_johnson_optimum_outside_the_first_grid(spark):
    rng = random.Random(8)
    xs = [-math.exp(rng.gauss(0, 1)) for _ in range(2000)] + [0.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    lam = pp.fit_yeo_johnson(df, ["x"])["x"]

    def ll(v):
        t = np.array([((-x + 1) ** (2 - v) - 1) / -(2 - v) if x < 0 else 0.0 for x in xs])
        return -len(xs) / 2 * math.log(np.var(t)) + (v - 1) * sum(math.copysign(math.log1p(abs(x)), x) for x in xs)

    assert lam > 2.3 and ll(lam) >= max(ll(lam - 0.01), ll(lam + 0.01))


def test_roles_are_exact_up_to_the_threshold(spark):
    df = spark.range(800).selectExpr("CAST(id % 80 AS INT) AS c")
    r = pp.detect_roles(df, threshold=100).first()
    assert (r["n_unique"], r["role"]) == (80, "ordinal")


def test_large_ordinal_dictionary_and_unknown_values(spark):
    from fareline.operators import models as md

    train = spark.range(3000).selectExpr("CAST(id * 1e6 AS DOUBLE) AS o", "CAST(id AS DOUBLE) AS c", "concat('k', id % 40) AS s")
    prep = md.fit_preprocessor(train, ["o", "s"], ["c"], [], scaled=False)
    rows = spark.createDataFrame([(2e6, 1.0, "k3"), (5.5, 1.0, "zz"), (None, 1.0, None)], "o double, c double, s string")
    got = [[float(x) for x in r["features"]][:2] for r in prep.transform(rows).collect()]
    labels = sorted(f"k{i}" for i in range(40))
    assert got == [[2.0, float(labels.index("k3"))], [-1.0, -1.0], [-1.0, -1.0]]


def test_runs_of_two_months_stay_apart(spark):
    from fareline.plans.monitoring import replay

    runs = [(19723, 5.0, 0.9, 0.05), (19754, 4.0, 0.9, 0.05), (19755, 3.99, 0.9, 0.05)]
    got = replay(spark, spark.createDataFrame(runs, "seq bigint, rmse double, r2 double, gap double")).orderBy("seq").collect()
    assert [r["decision"] for r in got] == ["PROMOTED", "PROMOTED", "REJECTED"]
    assert got[2]["champion_seq"] == 19754 and got[2]["champion_r2"] == 0.9


def test_every_trip_is_scored_or_has_a_reason(spark):
    from fareline.operators import pricing as prc

    rows = [(1, 20.0, 5.0), (2, 20.0, 140.0), (3, None, 5.0), (4, 20.0, None)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "id int, prediction double, trip_distance_km double, airport_trip int, is_rush_hour int")
    out = {r["id"]: r for r in df.select("id", *[c.alias(k) for k, c in prc.score_every_trip(df).items()]).collect()}
    assert (out[1]["predicted_fare_usd"], out[1]["unpriced_reason"]) == (20.0, None)
    assert (out[2]["predicted_fare_usd"], out[2]["unpriced_reason"]) == (None, "DISTANCE_ABOVE_LIMIT")
    assert out[3]["predicted_fare_usd"] == 15.0 and out[4]["unpriced_reason"] == "NO_DISTANCE"


def test_plans_without_self_join_and_scratch_left_behind(spark):
    import os

    from fareline.plans import load_all

    df = load_all()["met_errors_by_side"][0](spark, "/root/testdata/sf0.001")
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    base = spark.conf.get("spark.checkpoint.dir")
    before = {d for d in os.listdir(base) if "kept" in d}
    qt.quantile_values(spark.range(100).selectExpr("CAST(id AS DOUBLE) AS x"), ["x"], [0.5])
    assert {d for d in os.listdir(base) if "kept" in d} == before


def test_selected_family_is_the_one_refitted(spark):
    from fareline.operators import models as md

    rows = [("a", 0.01, 1.0, 0.05, 0.95, 2.0), ("b", 0.01, 1.0, 0.05, 0.95, 1.5), ("c", 0.5, 1.0, 0.05, 0.95, 1.0)]
    t = spark.createDataFrame(rows, "model string, train_test_gap double, cv_mean_rmse double, cv_std_rmse double, test_r2 double, test_rmse double")
    assert md.select_best(t).first()["model"] == "b"
