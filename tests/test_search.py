"""MOD-6: the search from shared state gives what direct refits give, covers the four families with the whole
budget, and its best setting reaches the champion."""

import inspect

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from fareline.config import CV_FOLDS, SEARCH_ITERS
from fareline.operators import models as md
from fareline.operators import prep as pp
from fareline.operators import search as sr
from fareline.plans import models as pm

SF = "/root/testdata/sf0.001"
TINY = {"linear": {"regParam": [0.0, 50.0]}, "tree": {"maxDepth": [1, 4]}, "forest": {"numTrees": [2], "maxDepth": [2]},
        "gbt": {"maxIter": [2], "maxDepth": [2]}}
TUNE = md.tune


@pytest.fixture(scope="module")
def train(spark):
    return pm.split_features(spark, SF).where(F.col("split") == "train")


@pytest.fixture(scope="module")
def prepared(spark, train):
    prep = md.fit_preprocessor(train, ["pickup_dow"], ["trip_distance_km", "bearing_deg", "pickup_hour"], ["is_weekend", "is_rush_hour"], scaled=True)
    return pm.written_table(prep.transform(train).select("event_id", "features", "fare_amount"), "search-test")


def refits(data, family, settings, folds):
    """RMSE [fold, setting] by fitting every setting in every fold."""
    ev = RegressionEvaluator(labelCol="fare_amount", metricName="rmse")
    d = data.withColumn("_fold", pp.kfold(k=folds, seed="42"))
    return np.array([[ev.evaluate(md.make_regressor(family, s).fit(d.where(F.col("_fold") != i)).transform(d.where(F.col("_fold") == i)))
                      for s in settings] for i in range(folds)])


@pytest.mark.parametrize("family,grid", [
    ("linear", {"regParam": [0.0, 0.01, 1.0, 10.0], "elasticNetParam": [0.0, 0.5, 1.0]}),
    ("tree", {"maxDepth": [2, 5, 8], "minInstancesPerNode": [1, 4]}),
    ("gbt", {"maxIter": [2, 5], "stepSize": [0.1], "maxDepth": [2]})])
def test_shared_state_gives_what_refits_give(spark, prepared, monkeypatch, family, grid):
    monkeypatch.setattr(md, "GRIDS", {family: grid})
    rows = md.tune(family, prepared, folds=3)
    want = refits(prepared, family, [s for s, _, _ in rows], 3)
    assert [a for _, a, _ in rows] == pytest.approx(list(want.mean(axis=0)), rel=1e-6)
    assert [b for _, _, b in rows] == pytest.approx(list(want.std(axis=0)), rel=1e-4, abs=1e-6)


def test_fewer_fits_than_settings():
    settings = sr.draw(md.GRIDS["forest"], 20, 42)
    fits = sr.shared_fits("forest", settings)
    assert sorted(i for _, members in fits for i in members) == list(range(len(settings)))
    assert [f for f, _ in fits] == [{"minInstancesPerNode": n, "numTrees": 200, "maxDepth": 20} for n in (2, 4)]
    assert len(sr.shared_fits("tree", sr.draw(md.GRIDS["tree"], 20, 42))) == 3
    assert len(sr.shared_fits("gbt", sr.draw(md.GRIDS["gbt"], 20, 42))) == 8


def test_feature_without_variance(spark):
    m = sr.Moments(4.0, np.array([0.0, 0.0, 0.0]), np.array([[4.0, 0, 6], [0, 0, 0], [6, 0, 9]]))
    w, b = sr.solve(m, 0.0, 0.0)
    assert list(w) == pytest.approx([1.5, 0.0]) and b == pytest.approx(0.0)
    assert sr.rmse(m, w, b) == pytest.approx(0.0, abs=1e-7)


def test_budget(monkeypatch, spark):
    calls = []
    monkeypatch.setattr(md, "tune", lambda family, data, **kw: calls.append((family, len(kw["tables"]))) or [({}, 1.0, 0.0)])
    monkeypatch.setattr(pm, "_TUNED", {})
    assert {r["model"] for r in pm._search(spark, SF).collect()} == set(pm.FAMILIES)
    assert {r["model"] for r in pm._search_refit(spark, SF).collect()} == set(pm.FAMILIES)
    assert calls == [(f, 1) for f in pm.FAMILIES] + [(f, CV_FOLDS) for f in pm.FAMILIES]
    defaults = {k: p.default for k, p in inspect.signature(TUNE).parameters.items()}
    assert (defaults["n_iter"], defaults["folds"]) == (SEARCH_ITERS, CV_FOLDS) == (20, 5)


def test_tuned_settings_reach_the_champion(monkeypatch, spark):
    monkeypatch.setattr(md, "GRIDS", TINY)
    monkeypatch.setattr(pm, "_TUNED", {})
    monkeypatch.setattr(pm, "_TRAINED", {})
    used = []
    fitted = pm.fitted
    monkeypatch.setattr(pm, "fitted", lambda s, sf, fam, params=None, **kw: used.append((fam, params)) or fitted(s, sf, fam, params, **kw))
    rows = pm._search_refit(spark, SF).collect()
    assert sorted(r["model"] for r in rows) == ["forest", "gbt", "linear", "linear", "tree", "tree"]
    best = {f: pm.best_setting(spark, SF, f) for f in pm.FAMILIES}
    for f in pm.FAMILIES:
        mine = [(r["cv_mean_rmse"], r["params"]) for r in rows if r["model"] == f]
        assert (best[f][1], str(sorted(best[f][0].items()))) in mine and best[f][1] == min(mine)[0]
    summary = {r["model"]: r for r in pm.trained_summary(spark, SF).collect()}
    for f in pm.FAMILIES:
        assert (f, best[f][0]) in used
        assert summary[f]["cv_mean_rmse"] == pytest.approx(best[f][1], abs=1e-4)
        assert summary[f]["cv_std_rmse"] == pytest.approx(best[f][2], abs=1e-4)
    used.clear()
    champion = pm._refit(spark, SF).first()["model"]
    assert used == [(champion, best[champion][0])]


@pytest.mark.parametrize("family", ["linear", "tree"])
def test_fold_preprocessing_as_in_a_pipeline(spark, train, family, monkeypatch):
    """One preprocessing fit a fold gives what fitting the whole pipeline on every training fold gives."""
    monkeypatch.setattr(md, "GRIDS", {"linear": {"regParam": [0.0, 1.0]}, "tree": {"maxDepth": [3, 5]}})
    columns = dict(ordinalCols=["pickup_dow"], continuousCols=["trip_distance_km"], binaryCols=["is_weekend"])
    rows = md.tune(family, train, folds=2, preprocessor=md.TripPreprocessor(**columns, scaled=True))
    ev = RegressionEvaluator(labelCol="fare_amount", metricName="rmse")
    d = train.withColumn("_fold", pp.kfold(k=2, seed="42"))
    for setting, mean, std in rows:
        pipe = Pipeline(stages=[md.TripPreprocessor(**columns, scaled=family == "linear"), md.make_regressor(family, setting)])
        want = [ev.evaluate(pipe.fit(d.where(F.col("_fold") != i)).transform(d.where(F.col("_fold") == i))) for i in range(2)]
        assert mean == pytest.approx(np.mean(want), rel=1e-6)
        assert std == pytest.approx(np.std(want), rel=1e-4, abs=1e-6)
