"""EXP-3 for trees and staged scores: against subset enumeration, additivity, and Spark ML's own predictions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fareline.operators import models as md
from fareline.operators import trees as tr

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        a, b, c = rng.uniform(0, 10), float(rng.randint(0, 3)), rng.gauss(0, 1)
        rows.append((a, b, c, rng.random(), 3 * a + (b == 2) * 20 + a * c + rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, fare_amount double")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).select("features", "fare_amount").repartition(3)


def expectation(t, x, known, node=0):
    """The tree's value for a row of which only the features in ``known`` are told."""
    if t.left[node] < 0:
        return t.value[node]
    f, left, right = t.feature[node], t.left[node], t.right[node]
    if f in known:
        return expectation(t, x, known, left if x[f] <= t.threshold[node] else right)
    return sum(t.cover[c] / t.cover[node] * expectation(t, x, known, c) for c in (left, right))


def enumerated(t, x, n):
    phi = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            for s in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                phi[i] += w * (expectation(t, x, {*s, i}) - expectation(t, x, set(s)))
    return phi


def test_equals_subset_enumeration(spark, data):
    model = md.make_regressor("tree", {"maxDepth": 6}).fit(data)
    (t,) = tr.tree_tables(spark, model)
    x = np.array([r[0].toArray() for r in data.select("features").limit(25).collect()])
    assert tr.shapley(x, t.leaves(4)) == pytest.approx(np.array([enumerated(t, r, 4) for r in x]), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("family,params", [("tree", {"maxDepth": 8}), ("forest", {"numTrees": 7, "maxDepth": 6}), ("gbt", {"maxIter": 9, "maxDepth": 3})])
def test_values_sum_to_prediction_minus_base(spark, data, family, params):
    model = md.make_regressor(family, params).fit(data)
    trees = tr.tree_tables(spark, model)
    base = tr.base_value(trees)
    phi = tr.tree_shap(F.col("features"), trees, 4, spark)
    rows = model.transform(data).select("prediction", phi.alias("phi")).collect()
    assert len(rows) == 400
    for r in rows:
        assert sum(r["phi"]) == pytest.approx(r["prediction"] - base, rel=1e-9, abs=1e-8)
    top = tr.mean_abs_shap(data, model, NAMES).orderBy(F.desc("mean_abs_shap")).first()
    assert top["feature"] == "a"


def test_single_leaf(spark, data):
    model = md.make_regressor("tree", {"maxDepth": 0}).fit(data)
    rows = data.select(tr.tree_shap(F.col("features"), tr.tree_tables(spark, model), 4, spark).alias("phi")).collect()
    assert {tuple(r["phi"]) for r in rows} == {(0.0,) * 4}
    assert data.limit(0).select(tr.tree_shap(F.col("features"), tr.tree_tables(spark, model), 4, spark)).count() == 0


def test_stages_of_a_tree_are_the_smaller_trees(spark, data):
    deep = tr.tree_tables(spark, md.make_regressor("tree", {"maxDepth": 9}).fit(data))
    got = data.select("features", tr.staged_predictions(F.col("features"), deep, [(1, 2), (1, 5), (1, None)], spark).alias("s"))
    for i, depth in enumerate((2, 5, 9)):
        model = md.make_regressor("tree", {"maxDepth": depth}).fit(data)
        far = model.transform(got).agg(F.max(F.abs(F.col("prediction") - F.col("s")[i]))).first()[0]
        assert far < 1e-9, depth


def test_stages_of_a_forest(spark, data):
    model = md.make_regressor("forest", {"numTrees": 6, "maxDepth": 5}).fit(data)
    trees = tr.tree_tables(spark, model)
    scored = model.transform(data).select("prediction", vector_to_array("features").alias("x"),
                                          tr.staged_predictions(F.col("features"), trees, [(6, None), (3, None), (6, 1)], spark).alias("s")).collect()
    for r in scored:
        x = np.array([r["x"]])
        assert r["s"][0] == pytest.approx(r["prediction"], rel=1e-12)
        assert r["s"][1] == pytest.approx(np.mean([t.at_depths(x, [None])[0, 0] for t in trees[:3]]), rel=1e-12)
        assert r["s"][2] == pytest.approx(np.mean([t.at_depths(x, [1])[0, 0] for t in trees]), rel=1e-12)


def random_tree(rng, depth, n_features):
    cells = []

    def grown(level, cover):
        at = len(cells)
        cells.append([-1, -1, 0, 0.0, rng.uniform(0, 9), cover])
        if level < depth and cover > 1:
            left = rng.randint(1, cover - 1)
            cells[at][2:4] = rng.randrange(n_features), rng.random()
            cells[at][:2] = grown(level + 1, left), grown(level + 1, cover - left)
        return at

    grown(0, 5000)
    return tr.Tree(*(np.array(c) for c in zip(*cells)))


def test_values_are_worked_out_once_a_set_of_satisfied_features(monkeypatch):
    """4,000 rows cost no more evaluations than there are sets; few rows on long paths are evaluated one by one, alike."""
    t = random_tree(random.Random(4), 8, 7)
    x = np.random.default_rng(4).random((4000, 7))
    leaves, evaluated, real = t.leaves(7), [], tr._leaf_values
    monkeypatch.setattr(tr, "_leaf_values", lambda o, z, v: evaluated.append(z[..., 0].size * o.shape[-2] // max(1, o.shape[0])) or real(o, z, v))
    phi = tr.shapley(x, leaves)
    sets = sum(2 ** int((np.isfinite(a) | np.isfinite(b)).sum()) for a, b in zip(leaves[1], leaves[2]))
    assert sum(evaluated) <= sets < len(x) * len(leaves[0]) / 4
    few = np.concatenate([tr.shapley(x[i:i + 3], leaves) for i in range(0, 30, 3)])
    assert few == pytest.approx(phi[:30], abs=1e-12)
    assert phi[:10] == pytest.approx(np.array([enumerated(t, r, 7) for r in x[:10]]), abs=1e-9)
    assert phi.sum(axis=1) == pytest.approx(t.at_depths(x, [None])[:, 0] - tr.base_value([t]), abs=1e-9)


def test_batches_held_together_keep_their_rows(spark, data, monkeypatch):
    model = md.make_regressor("forest", {"numTrees": 3, "maxDepth": 4}).fit(data)
    trees = tr.tree_tables(spark, model)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = model.transform(data).select("features", "prediction", tr.tree_shap(F.col("features"), trees, 4, spark).alias("phi")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = sum(t.weight * tr.shapley(np.array([r["features"].toArray() for r in rows]), t.leaves(4)) for t in trees)
    assert np.array([r["phi"] for r in rows]) == pytest.approx(want, abs=1e-9) and len(rows) == 400


def test_subtrees_grown_in_tasks_are_spark_mls(spark):
    """Label and features without ties in gain: the levels below the top are those of a whole fit."""
    rng = random.Random(8)
    rows = [(i, rng.random(), rng.random(), float(rng.randint(0, 6))) for i in range(3000)]
    df = spark.createDataFrame([(i, a, b, c, 40 * a * a + 9 * math.sin(9 * b) + c * c + rng.gauss(0, 2)) for i, a, b, c in rows],
                               "id int, a double, b double, c double, fare_amount double").repartition(3)
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()
    is_train = F.col("id") % 4 != 0
    train, valid = df.where(is_train), df.where(~is_train)
    cuts = tr.split_candidates(train, md.make_regressor("tree"), "features", 3)
    assert [len(c) for c in cuts] == [31, 31, 6]
    top = md.make_regressor("tree", {"maxDepth": 3, "minInstancesPerNode": 20}).fit(train)
    (t,) = tr.tree_tables(spark, top)
    got = tr.grown_errors(df, is_train, t, cuts, [5, 7, None], top_depth=3, min_rows=20, features="features", label="fare_amount")
    for depth, rmse in zip((5, 7, 30), got):
        m = md.make_regressor("tree", {"maxDepth": depth, "minInstancesPerNode": 20}).fit(train)
        assert rmse == pytest.approx(m.transform(valid).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("fare_amount"), F.lit(2.0))))).first()[0], rel=1e-6)
    df.unpersist()


def test_a_deep_tree_search_never_fits_or_reads_a_deep_tree(spark, monkeypatch):
    from fareline.operators import search as sr

    rng = random.Random(9)
    df = spark.createDataFrame([(i, rng.random(), rng.random(), rng.gauss(0, 1)) for i in range(600)], "event_id long, a double, b double, fare_amount double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    fitted, real = [], md.make_regressor
    monkeypatch.setattr(sr, "TOP", 3)
    monkeypatch.setattr(sr, "WHOLE_ROWS", 100)
    monkeypatch.setattr(md, "GRIDS", {"tree": {"maxDepth": [2, 12], "minInstancesPerNode": [5]}})
    monkeypatch.setattr(md, "make_regressor", lambda f, s=None, *a: fitted.append(dict(s or {})) or real(f, s, *a))
    rows = md.tune("tree", df, folds=2)
    assert len(rows) == 2 and rows[0][1] != rows[1][1]
    assert {f["maxDepth"] for f in fitted if f} == {3}
