"""What a search asks of the driver at a time: plans whose size does not follow a grid's, few boosting fits."""

import threading
import time

import numpy as np
import pytest

from fareline.operators import prep as pp
from fareline.operators import search as sr


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a = [None if i % 11 == 0 else float("nan") if i % 13 == 0 else float(v) for i, v in enumerate(rng.gamma(2.0, 3.0, 400) - 2.0)]
    b = [40.6 + float(v) / 1e3 for v in rng.normal(size=400)]
    return spark.createDataFrame(list(zip(a, b, [None] * 400)), "a double, b double, empty double").repartition(5)


def test_sums_of_a_grid(rows):
    """Those of the SQL aggregates; nearly equal values far from zero and the special cases 0 and 2 too."""
    grids = {"a": [-2.0, 0.0, 0.5, 2.0, 2.7], "b": [-2.0, 0.0, 1.0], "empty": [0.0, 1.0]}
    clean = rows.select([pp.number(rows, c).alias(c) for c in grids])
    got, want = pp.yj_moments(clean, grids), clean.selectExpr(*pp._yj_aggs(grids)).first()
    assert list(got) == ["a", "b"]
    for c, (n, s, variances) in got.items():
        assert n == want[f"{c}__n"] and s == pytest.approx(want[f"{c}__s"], rel=1e-12)
        assert variances == pytest.approx([want[f"{c}__v{i}"] for i in range(len(grids[c]))], rel=1e-7)


def test_plan_of_the_fit_does_not_follow_the_grid(rows, monkeypatch):
    asked = []
    for name in ("selectExpr", "agg"):
        known = getattr(type(rows), name)
        monkeypatch.setattr(type(rows), name, lambda self, *x, known=known: asked.append(len(x)) or known(self, *x))
    found = pp.fit_yeo_johnson(rows, ["a", "b", "empty"], points=21)
    assert found["empty"] == 1.0 and 0.0 < found["a"] < 1.0
    assert max(asked) <= 3


def test_boosting_fits_at_a_time(spark, monkeypatch):
    held, most, lock = [0], [0], threading.Lock()

    class Fit:
        def fit(self, train):
            with lock:
                held[0] += 1
                most[0] = max(most[0], held[0])
            time.sleep(0.2)
            with lock:
                held[0] -= 1

    monkeypatch.setattr(sr, "staged_rmse", lambda family, model, valid, settings, *a: [1.0] * len(settings))
    table = spark.range(3)
    settings = [{"maxDepth": d} for d in range(8)]
    out = sr.staged_scores("gbt", lambda s: Fit(), [(table, table)] * 2, settings, features="f", label="y", parallelism=8)
    assert most[0] == sr.BOOST_FITS and (out == 1.0).all() and out.shape == (2, 8)
