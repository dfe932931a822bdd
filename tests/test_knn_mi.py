"""SEL-1: the distributed nearest-neighbour estimator equals a brute-force one."""

import random

import numpy as np
import pytest

from fareline.operators import knn_mi as mi


def brute(x, y, k=3):
    x, y = np.asarray(x, float), np.asarray(y, float)
    dx, dy = np.abs(x[:, None] - x[None, :]) / (x.std() or 1.0), np.abs(y[:, None] - y[None, :]) / (y.std() or 1.0)
    d = np.maximum(dx, dy)
    np.fill_diagonal(d, np.inf)
    r = np.nextafter(np.sort(d, axis=1)[:, k - 1], 0)
    nx, ny = (dx <= r[:, None]).sum(axis=1), (dy <= r[:, None]).sum(axis=1)
    n = len(x)
    return max(0.0, float(mi.digamma(np.array([n]))[0] + mi.digamma(np.array([k]))[0] - np.mean(mi.digamma(nx) + mi.digamma(ny))))


def test_digamma():
    euler = 0.5772156649015329
    assert mi.digamma(np.array([1.0, 2.0, 3.0, 100.0])) == pytest.approx([-euler, 1 - euler, 1.5 - euler, 4.600161852738087], abs=1e-12)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for i in range(2500):
        a = rng.gauss(0, 1)
        y = round(8 * (10 + 3 * a + rng.gauss(0, 1))) / 8      # many ties
        out.append((i, a, float(rng.randint(0, 5)), 2.5, rng.expovariate(1) ** 3, None if i % 7 == 0 else y * 2, y))
    return out


@pytest.mark.parametrize("strip", [mi.STRIP, 700, 90])
def test_equals_brute_force(spark, rows, strip):
    names = ["near", "steps", "same", "skewed", "copy"]
    df = spark.createDataFrame(rows, "id long, near double, steps double, same double, skewed double, copy double, y double").repartition(4)
    got = {r["feature"]: r["mi"] for r in mi.knn_mutual_information(df, names, "y", strip=strip).collect()}
    for i, f in enumerate(names, 1):
        have = [(r[i], r[-1]) for r in rows if r[i] is not None]
        assert got[f] == pytest.approx(brute(*zip(*have)), abs=1e-9), f
    assert got["copy"] > got["near"] > got["steps"]


def test_nearest_against_all_pairs():
    rng = np.random.default_rng(3)
    px, py, pw = rng.integers(0, 6, 60) / 2, rng.random(60), rng.integers(1, 4, 60)
    qx, qy = rng.random(40) * 3, rng.random(40)
    for bound in (None, np.full(40, 0.3)):
        got = mi.nearest(qx, qy, px, py, pw, 3, bound)
        for i in range(40):
            d = np.repeat(np.maximum(np.abs(px - qx[i]), np.abs(py - qy[i])), pw)
            d = np.sort(d[d < (np.inf if bound is None else bound[i])])[:3]
            assert list(got[i][:len(d)]) == list(d) and np.isinf(got[i][len(d):]).all()


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (None, 3.0)], "a double, y double")
    assert mi.knn_mutual_information(df, ["a"], "y").count() == 0
    assert mi.knn_mutual_information(df.limit(0), ["a"], "y").count() == 0


def test_strips_to_ask_for_many_points_at_once():
    rng = np.random.default_rng(5)
    x0 = np.sort(rng.random(40))
    box = np.column_stack([np.arange(40), x0, np.append(x0[1:], 1.0), rng.random(40) / 2, 0.5 + rng.random(40) / 2])
    x, y, dx, dy = rng.random(300), rng.random(300), rng.random(300) / 9 * (rng.random(300) > 0.2), rng.random(300) / 9
    q, strips = mi._near_strips(box, 7, x, y, dx, dy)
    want = [(i, int(s)) for i in range(300) for s, a, b, c, d in box
            if dx[i] > 0 and s != 7 and b >= x[i] - dx[i] and a <= x[i] + dx[i] and c <= y[i] + dy[i] and d >= y[i] - dy[i]]
    assert sorted(zip(q.tolist(), strips.tolist())) == sorted(want) and list(q) == sorted(q)
