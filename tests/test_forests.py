"""MOD-6 forests grown in tasks: against a forest grown row by row, Spark ML's error, and a driver that never holds a deep tree."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from fareline.operators import forests as fo
from fareline.operators import models as md
from fareline.operators import search as sr
from fareline.operators import trees as tr
from fareline.plans import models as pm

STAGES = [(4, 3), (9, 3), (4, 12), (9, 12)]
DRAWS = dict(min_rows=8, n_asked=2, seed=42, rate=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    made = [(i, rng.random(), rng.random(), float(rng.randint(0, 6)), rng.random()) for i in range(1500)]
    made += made[:50]       # copies are rows of their own
    df = spark.createDataFrame([(i, a, b, c, d, 40 * a * a + 9 * math.sin(9 * b) + c * c + random.Random(i).gauss(0, 2)) for i, a, b, c, d in made],
                               "event_id long, a double, b double, c double, d double, fare_amount double").repartition(3)
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    return pm.written_table(df.select("event_id", "features", "fare_amount"), "forest-test")


@pytest.fixture(scope="module")
def cuts(rows):
    return tr.split_candidates(rows.where(F.col("event_id") % 4 != 0), DecisionTreeRegressor(labelCol="fare_amount", seed=42), "features", 4)


def errors(rows, cuts, stages=STAGES, **kw):
    return fo.forest_errors(rows, F.col("event_id") % 4 != 0, cuts, stages, features="features", label="fare_amount", **{**DRAWS, **kw})


def variance(w, y):
    m = (w * y).sum() / w.sum()
    return (w * y * y).sum() / w.sum() - m * m


def plain_tree(x, y, w, cuts, path, depth, valid):
    """[depth + 1, valid row]: predictions of a tree cut at each depth, grown node by node."""
    value = (w * y).sum() / w.sum()
    out = np.full((depth + 1, len(valid)), value)
    if depth == 0 or variance(w, y) < tr.EPSILON:
        return out
    best = (0.0, None, None)
    for f in tr.asked_features(np.array([path], np.uint64), x.shape[1], 2)[0]:
        for t in cuts[f]:
            left = x[:, f] <= t
            if min(w[left].sum(), w[~left].sum()) >= DRAWS["min_rows"]:
                share = w[left].sum() / w.sum()
                gain = variance(w, y) - share * variance(w[left], y[left]) - (1 - share) * variance(w[~left], y[~left])
                if gain > best[0] + 1e-9:
                    best = (gain, f, t)
    if best[1] is None:
        return out
    _, f, t = best
    below = tr.child_paths(np.array([path], np.uint64))[0]
    for side, (here, there) in enumerate([(x[:, f] <= t, valid[:, f] <= t), (x[:, f] > t, valid[:, f] > t)]):
        out[1:, there] = plain_tree(x[here], y[here], w[here], cuts, below[side], depth - 1, valid[there])
    return out


def test_equals_a_forest_grown_node_by_node(rows, cuts):
    got = errors(rows, cuts)
    local = rows.select(F.monotonically_increasing_id().alias("i"), "event_id", vector_to_array("features").alias("x"), "fare_amount").collect()
    ids, x, y = (np.array([r[c] for r in local]) for c in ("i", "x", "fare_amount"))
    train = np.array([r["event_id"] % 4 != 0 for r in local])
    total, at = np.zeros((13, (~train).sum())), {}
    for i in range(9):
        w = fo.drawn(ids[train], i, 42, 0.3).astype(float)
        path = tr.mixed(np.array([42 * 1_000_003 + i], np.uint64))[0]
        total += plain_tree(x[train][w > 0], y[train][w > 0], w[w > 0], cuts, path, 12, x[~train])
        at[i + 1] = total / (i + 1)
    want = [np.sqrt(((at[n][d] - y[~train]) ** 2).mean()) for n, d in STAGES]
    assert got == pytest.approx(want, rel=1e-9)


def test_large_nodes_split_over_tasks_give_the_same_forest(rows, cuts, monkeypatch):
    want = errors(rows, cuts)
    monkeypatch.setattr(fo, "LEAF_ROWS", 60)
    divided, divide = [], fo.Top.divide
    monkeypatch.setattr(fo.Top, "divide", lambda self, *a: divided.append(a) or divide(self, *a))
    assert errors(rows, cuts) == pytest.approx(want, rel=1e-9)
    assert len(divided) > 9


def test_draws_are_poisson_and_differ_between_trees():
    ids = np.arange(200_000) + (np.arange(200_000) % 7 << 33)
    a, b = (fo.drawn(ids, t, 42, 0.3) for t in (0, 1))
    for w in (a, b):
        assert [(w == i).mean() for i in range(4)] == pytest.approx([math.exp(-0.3) * 0.3 ** i / math.factorial(i) for i in range(4)], abs=0.004)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01
    asked = tr.asked_features(tr.mixed(np.arange(100_000, dtype=np.uint64)), 12, 4)
    assert asked.shape == (100_000, 4) and (np.diff(asked, axis=1) > 0).all()
    assert np.bincount(asked.ravel()) / 100_000 == pytest.approx(np.full(12, 1 / 3), abs=0.01)


def test_error_is_near_spark_mls(rows, cuts):
    train, valid = rows.where(F.col("event_id") % 4 != 0), rows.where(F.col("event_id") % 4 == 0)
    (got,) = errors(rows, cuts, [(60, 12)])
    model = md.make_regressor("forest", {"numTrees": 60, "maxDepth": 12, "minInstancesPerNode": 8}).fit(train)
    want = model.transform(valid).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("fare_amount"), F.lit(2.0))))).first()[0]
    assert got == pytest.approx(want, rel=0.05)


def test_a_forest_search_never_fits_or_reads_a_forest(rows, monkeypatch):
    read, real = [], tr.tree_tables
    monkeypatch.setattr(sr, "FOREST_ROWS", 100)
    monkeypatch.setattr(md, "GRIDS", {"forest": {"numTrees": [3, 6], "maxDepth": [2, 12], "minInstancesPerNode": [2, 5]}})
    monkeypatch.setattr(tr, "tree_tables", lambda s, m: read.append(type(m).__name__) or real(s, m))
    found = md.tune("forest", rows, folds=2)
    assert len(found) == 8 and len({a for _, a, _ in found}) >= 6 and all(0 < a < 30 for _, a, _ in found)
    assert set(read) == {"DecisionTreeRegressionModel"}     # one feature each: the split candidates


@pytest.mark.parametrize("leaf_rows", [500_000, 60])
def test_a_fitted_forest_is_a_table_that_is_saved_and_loaded(spark, rows, cuts, monkeypatch, tmp_path, leaf_rows):
    monkeypatch.setattr(sr, "FOREST_ROWS", 100)
    monkeypatch.setattr(fo, "LEAF_ROWS", leaf_rows)
    train = pm.written_table(rows.where(F.col("event_id") % 4 != 0), "forest-train")
    model = md.fit_regressor("forest", {"numTrees": 9, "maxDepth": 12, "minInstancesPerNode": 8}, train)
    assert isinstance(model.stages[-1], fo.ForestModel)
    scored = model.transform(rows).collect()
    assert len(scored) == 1550 and set(scored[0].asDict()) == {"event_id", "features", "fare_amount", "prediction"}
    path = md.save_artifacts(str(tmp_path / "m"), model, md.Preprocessor(binary=["a"]), {"family": "forest"})
    loaded, _, meta = md.load_artifacts(path)
    again = loaded.transform(rows).collect()
    key = lambda r: (r["event_id"], r["prediction"])
    assert sorted(map(key, again)) == sorted(map(key, scored)) and meta["family"] == "forest"
    error = np.sqrt(np.mean([(r["prediction"] - r["fare_amount"]) ** 2 for r in scored if r["event_id"] % 4 == 0]))
    assert error == pytest.approx(errors(rows, cuts, [(9, 12)])[0], rel=0.06)


def test_shallow_or_small_forests_stay_spark_mls(rows, monkeypatch):
    train = rows.where(F.col("event_id") % 4 != 0)
    assert type(md.fit_regressor("forest", {"numTrees": 2, "maxDepth": 12}, train).stages[-1]).__name__ == "RandomForestRegressionModel"
    monkeypatch.setattr(sr, "FOREST_ROWS", 100)
    assert type(md.fit_regressor("forest", {"numTrees": 2, "maxDepth": 4}, train).stages[-1]).__name__ == "RandomForestRegressionModel"


def test_boosting_reads_few_partitions_and_the_same_rows(rows, monkeypatch):
    assert sr.few_partitions(rows.repartition(6)).rdd.getNumPartitions() == 6
    monkeypatch.setattr(sr, "FOREST_ROWS", 100)
    monkeypatch.setattr(sr, "BOOST_ROWS", 800)
    few = sr.few_partitions(rows.repartition(6))
    assert few.rdd.getNumPartitions() == 2 and few.count() == 1550
