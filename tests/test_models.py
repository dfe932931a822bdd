"""MOD-3 and MOD-7 at size: forests keep each row's nodes between levels, and a comparison reads its predictions once."""

import random

import pytest
from pyspark.ml.feature import VectorAssembler

from fareline.operators import models as md


def test_forest_with_cached_node_ids_is_the_same_forest(spark):
    rng = random.Random(3)
    rows = [(a, b, 5 * a + (b > 0.4) * 7 + rng.gauss(0, 1)) for a, b in ((rng.random(), rng.random()) for _ in range(600))]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, fare_amount double").repartition(3)).cache()
    forest = md.make_regressor("forest", {"numTrees": 6, "maxDepth": 7})
    assert forest.getCacheNodeIds()
    plain = md.make_regressor("forest", {"numTrees": 6, "maxDepth": 7, "cacheNodeIds": False})
    text = [m.fit(df).toDebugString.split("\n", 1)[1] for m in (forest, plain)]     # all splits and predictions
    assert text[0] == text[1]
    df.unpersist()


def test_comparison_reads_the_predictions_once(spark):
    rows = [("a", "train", 10.0, 11.0), ("a", "train", 20.0, 18.0), ("a", "test", 10.0, 10.0), ("a", "test", 20.0, 24.0),
            ("a", "calibration", 1.0, 9.0), ("no test", "train", 1.0, 2.0), ("no train", "test", 1.0, 2.0), (None, "train", 1.0, 2.0),
            (None, "test", 1.0, 2.0), ("null", "train", None, 2.0), ("null", "test", 1.0, 1.0), ("null", None, 1.0, 1.0)]
    long = spark.createDataFrame(rows, "model string, split string, actual double, predicted double")
    table = md.comparison_table(long, n_features=1)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    got = {r["model"]: r for r in table.collect()}
    assert set(got) == {"a", "null"}
    a = got["a"]
    assert (a["train_r2"], a["test_r2"], a["train_test_gap"]) == (0.9, 0.68, 0.22)
    assert a["test_rmse"] == pytest.approx(8 ** 0.5, abs=1e-4) and a["test_mae"] == 2.0 and a["within_15pct_acc"] == 0.5
    assert got["null"]["train_r2"] is None and got["null"]["test_r2"] == 1.0
