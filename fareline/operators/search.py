"""MOD-6: cross-validated search from shared state.

Settings of one family that differ only in what can be read off a larger fit share it.

* linear: one aggregate gives each fold's moments (n, sums, X'X, X'y, y'y). A training set is all folds but one, so its
  moments are a subtraction, and every setting x fold is solved on k x k numbers: normal equations for a ridge, coordinate
  descent where there is an L1 part. The validation error comes from the left-out fold's moments.
* tree, forest: a tree cut at depth d is the tree of maxDepth d, a forest's first n trees are a forest of n trees; so
  one fit per leaf size, of the largest depth and number, is scored at every stage in one pass. Of more than
  ``WHOLE_ROWS`` rows, a decision tree's levels below ``TOP`` grow leaf by leaf in many tasks, on Spark ML's split candidates and by its rule. Forests of
  more than ``FOREST_ROWS`` rows grow in tasks altogether (``forests``), with draws of their own.
* boosting: the first m trees are the model of m iterations; one fit per step size, depth and rate, read off at every iteration. Of
  more than ``BOOST_WHOLE`` rows, all fits of all folds go in step, one pass a level for all of them (``boosting``), with draws of their own.

Settings are those of Spark ML's regressors, and so are the linear penalties (on standardised features and label).
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting as bo
from . import forests as fo
from . import trees as tr

STAGED = {"tree": ("maxDepth",), "forest": ("numTrees", "maxDepth"), "gbt": ("maxIter",)}      # read off a larger fit

TOP = 10                    # levels of a decision tree that Spark ML grows in a search
WHOLE_ROWS = 50_000         # training rows up to which it grows the whole tree
FOREST_ROWS = 10_000        # training rows up to which it grows whole forests
BOOST_WHOLE = 1_000         # training rows up to which it grows boosted trees
BOOST_ROWS = 100_000        # training rows of a partition of more rows than that, for boosting
BOOST_FITS = 4              # boosting fits at a time: each leaves the driver what a few hundred jobs hold until its garbage is collected
_CUTS: dict = {}            # split candidates of a fold, which the families of a search share
LEAF_ROWS = 2_000_000       # training rows of a leaf below which one task may grow on


def draw(grid: dict[str, list], n_iter: int, seed: int) -> list[dict]:
    """A seeded sample of ``n_iter`` settings of the grid, or all of a smaller one."""
    full = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(full, min(n_iter, len(full)))


# --- linear family -------------------------------------------------------------------

@dataclass
class Moments:
    """Sums of one set of rows about ``shift`` (the label last)."""
    n: float
    s: np.ndarray       # sums of the k features and the label
    p: np.ndarray       # sums of their products

    def __add__(self, o: "Moments") -> "Moments":
        return Moments(self.n + o.n, self.s + o.s, self.p + o.p)

    def __sub__(self, o: "Moments") -> "Moments":
        return Moments(self.n - o.n, self.s - o.s, self.p - o.p)


def fold_moments(df: DataFrame, features: str, label: str, fold: str) -> dict[int, Moments]:
    """fold -> moments; one pass for the shift (the means, against cancellation) and one aggregate for all products."""
    a = df.select(F.col(fold).alias("fold"), F.concat(vector_to_array(features), F.array(F.col(label).cast("double"))).alias("a"))
    first = a.select(F.size("a").alias("k")).first()
    if first is None:
        return {}
    k = first["k"]
    shift = a.agg(*[F.avg(F.col("a")[i]).alias(f"m{i}") for i in range(k)]).first()
    x = a.select("fold", *[(F.col("a")[i] - F.lit(shift[i])).alias(f"x{i}") for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rows = x.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(k)],
                                 *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs]).collect()   # one per fold
    out = {}
    for r in rows:
        p = np.zeros((k, k))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[r["fold"]] = Moments(float(r["n"]), np.array([r[f"s{i}"] for i in range(k)]), p)
    return out


def solve(m: Moments, reg: float, l1_ratio: float, tol: float = 1e-13, rounds: int = 100_000) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) about the shift: least squares with ``reg`` times an L1 part (``l1_ratio``) and an L2 part
    on standardised features and label. A feature that does not vary has coefficient 0."""
    mean = m.s / m.n
    cov = m.p / m.n - np.outer(mean, mean)
    c, b, var = cov[:-1, :-1], cov[:-1, -1], np.diag(cov)
    live = var[:-1] > 1e-18 * np.maximum(1.0, mean[:-1] ** 2)
    sd, sy = np.sqrt(np.where(live, var[:-1], 1.0)), np.sqrt(max(var[-1], 0.0))
    w = np.zeros(len(b))
    if live.any() and sy > 0:
        c, b = (c / np.outer(sd, sd))[np.ix_(live, live)], (b / sd / sy)[live]
        l1, l2 = reg * l1_ratio / sy, reg * (1 - l1_ratio) / sy
        a = c + l2 * np.eye(len(b))
        if l1 == 0:
            u = np.linalg.lstsq(a, b, rcond=1e-12)[0]
        else:
            u = np.zeros(len(b))
            for _ in range(rounds):
                most = 0.0
                for j in range(len(b)):
                    rest = b[j] - a[j] @ u + a[j, j] * u[j]
                    new = np.sign(rest) * max(abs(rest) - l1, 0.0) / a[j, j]
                    most, u[j] = max(most, abs(new - u[j])), new
                if most < tol:
                    break
        w[live] = u * sy / sd[live]
    return w, float(mean[-1] - mean[:-1] @ w)


def rmse(m: Moments, w: np.ndarray, intercept: float) -> float:
    """Of the rows behind the moments."""
    v = np.append(-w, 1.0)
    sse = v @ m.p @ v - 2 * intercept * (v @ m.s) + m.n * intercept ** 2
    return float(np.sqrt(max(sse, 0.0) / m.n)) if m.n else float("nan")


def linear_scores(per_fold: Callable[[int], tuple[Moments, Moments]], folds: int, settings: list[dict]) -> np.ndarray:
    """RMSE [fold, setting]; ``per_fold(i)`` gives the moments of fold i's training and validation rows."""
    out = np.empty((folds, len(settings)))
    for i in range(folds):
        train, valid = per_fold(i)
        for s, setting in enumerate(settings):
            out[i, s] = rmse(valid, *solve(train, setting.get("regParam", 0.0), setting.get("elasticNetParam", 0.0)))
    return out


# --- tree families ---------------------------------------------------------------------

def shared_fits(family: str, settings: list[dict]) -> list[tuple[dict, list[int]]]:
    """(setting to fit, numbers of the settings read off it)."""
    groups: dict[tuple, list[int]] = {}
    for i, s in enumerate(settings):
        groups.setdefault(tuple(sorted((k, v) for k, v in s.items() if k not in STAGED[family])), []).append(i)
    return [({**dict(key), **{k: max(settings[i][k] for i in members) for k in STAGED[family] if k in settings[members[0]]}}, members)
            for key, members in groups.items()]


def fold_candidates(rows: DataFrame, train: Column, regressor, features: str, label: str) -> list[np.ndarray]:
    """``forests.candidates`` of a fold's training rows, worked out once for all families: they depend on the rows, the seed and the
    number of bins only. A fold is known by the folder of its written table, which no other table gets."""
    key = (tuple(rows.inputFiles()), train._jc.toString(), regressor.getOrDefault("seed"), regressor.getOrDefault("maxBins"), features)
    if key not in _CUTS:
        _CUTS[key] = fo.candidates(rows.where(train), regressor, features, label)
    return _CUTS[key]


def staged_rmse(family: str, model, valid: DataFrame, settings: list[dict], features: str, label: str) -> list[float]:
    """RMSE on ``valid`` of each setting, read off one fitted model."""
    spark = valid.sparkSession
    if family == "gbt":
        errors = model.evaluateEachIteration(valid, "squared")
        return [float(np.sqrt(errors[s.get("maxIter", len(errors)) - 1])) for s in settings]
    trees = tr.tree_tables(spark, model)
    stages = [(s.get("numTrees", len(trees)), s.get("maxDepth")) for s in settings]
    scored = valid.select(F.col(label).alias("y"), tr.staged_predictions(F.col(features), trees, stages, spark).alias("s"))
    row = scored.agg(*[F.sqrt(F.avg((F.col("s")[i] - F.col("y")) * (F.col("s")[i] - F.col("y")))).alias(f"e{i}") for i in range(len(stages))]).first()
    return [float(v) for v in row]


def tree_rmse(make: Callable[[dict], object], fit: dict, rows: DataFrame, train: DataFrame, train_rows: Column, valid: DataFrame, settings: list[dict],
              levels: int, candidates: Callable[[], list[np.ndarray]], features: str, label: str) -> list[float]:
    """RMSE of each setting of one decision tree: Spark ML grows it to ``levels``, more if a leaf is left with more than
    ``LEAF_ROWS`` rows; deeper settings grow on from there in many tasks."""
    spark, deepest = train.sparkSession, fit.get("maxDepth", tr.SPARK_DEPTH)
    depth = min(levels, deepest)
    while True:
        model = make({**fit, "maxDepth": depth}).fit(train)
        (top,) = tr.tree_tables(spark, model)
        if depth == deepest or top.cover[top.left < 0].max() <= LEAF_ROWS:
            break
        depth = min(depth + 4, deepest)
    deep = [i for i, s in enumerate(settings) if s.get("maxDepth", deepest) > depth]
    flat = [i for i in range(len(settings)) if i not in deep]
    out = np.empty(len(settings))
    if flat:
        out[flat] = staged_rmse("tree", model, valid, [settings[i] for i in flat], features, label)
    if deep:
        out[deep] = tr.grown_errors(rows, train_rows, top, candidates(), [settings[i].get("maxDepth") for i in deep], top_depth=depth,
                                    min_rows=fit.get("minInstancesPerNode", 1), features=features, label=label)
    return list(out)


def tree_scores(make: Callable[[dict], object], tables: list[tuple[DataFrame, Column]], settings: list[dict], *, features: str, label: str,
                parallelism: int) -> np.ndarray:
    """RMSE [fold, setting] of decision trees; a fold is a table and the condition of its training rows."""
    out = np.empty((len(tables), len(settings)))
    fits, spark = shared_fits("tree", settings), tables[0][0].sparkSession

    def fold(i: int) -> None:
        rows, is_train = tables[i]
        train, valid, found = rows.where(is_train), rows.where(~is_train), []

        levels = TOP if train.count() > WHOLE_ROWS else tr.SPARK_DEPTH

        def candidates() -> list[np.ndarray]:
            if not found:
                found.append(fold_candidates(rows, is_train, make({}), features, label))
            return found[0]

        for fit, members in fits:
            out[i, members] = tree_rmse(make, fit, rows, train, is_train, valid, [settings[m] for m in members], levels, candidates, features, label)

    with ThreadPool(min(parallelism, len(tables))) as pool:
        pool.map(inheritable_thread_target(spark)(fold), range(len(tables)), chunksize=1)
    return out


def forest_scores(make: Callable[[dict], object], tables: list[tuple[DataFrame, Column]], settings: list[dict], *, features: str, label: str,
                  parallelism: int) -> np.ndarray:
    """RMSE [fold, setting] of forests; a fold is a written table and the condition of its training rows."""
    out = np.empty((len(tables), len(settings)))
    whole = [i for i, (rows, is_train) in enumerate(tables) if rows.where(is_train).count() <= FOREST_ROWS]
    if whole:
        pairs = [(tables[i][0].where(tables[i][1]), tables[i][0].where(~tables[i][1])) for i in whole]
        out[whole] = staged_scores("forest", make, pairs, settings, features=features, label=label, parallelism=parallelism)
    for i in (i for i in range(len(tables)) if i not in whole):      # one after another: a fit fills the cluster
        rows, is_train = tables[i]
        forest = make({})
        cuts = fold_candidates(rows, is_train, forest, features, label)
        for fit, members in shared_fits("forest", settings):
            stages = [tuple(settings[m].get(p, forest.getOrDefault(p)) for p in ("numTrees", "maxDepth")) for m in members]
            out[i, members] = fo.forest_errors(rows, is_train, cuts, stages, min_rows=fit.get("minInstancesPerNode", 1), features=features, label=label,
                                               **fo.draws(forest, len(cuts)))
    return out


def boosting_scores(make: Callable[[dict], object], tables: list[tuple[DataFrame, Column]], settings: list[dict], *, features: str, label: str,
                    parallelism: int) -> np.ndarray:
    """RMSE [fold, setting] of boosted trees; a fold is a written table and the condition of its training rows."""
    out = np.empty((len(tables), len(settings)))
    whole = [i for i, (rows, is_train) in enumerate(tables) if rows.where(is_train).count() <= BOOST_WHOLE]
    if whole:
        pairs = [(tables[i][0].where(tables[i][1]), tables[i][0].where(~tables[i][1])) for i in whole]
        out[whole] = staged_scores("gbt", make, pairs, settings, features=features, label=label, parallelism=parallelism)
    large = [i for i in range(len(tables)) if i not in whole]
    if large:
        spark, gbt, groups = tables[0][0].sparkSession, make({}), shared_fits("gbt", settings)
        value = lambda setting, p: setting.get(p, gbt.getOrDefault(p))
        fits = [bo.Fit(value(fit, "stepSize"), value(fit, "maxDepth"), value(fit, "subsamplingRate"), value(fit, "maxIter")) for fit, _ in groups]
        stages = [{value(settings[m], "maxIter") for m in members} for _, members in groups]
        with ThreadPool(min(parallelism, len(large))) as pool:
            cuts = pool.map(inheritable_thread_target(spark)(lambda i: fold_candidates(*tables[i], gbt, features, label)), large, chunksize=1)
        found = bo.staged_errors([tables[i] for i in large], cuts, fits, stages, min_rows=gbt.getOrDefault("minInstancesPerNode"),
                                 seed=gbt.getOrDefault("seed"), features=features, label=label)
        for i, each in zip(large, found):
            for (_, members), by_trees in zip(groups, each):
                for m in members:
                    out[i, m] = by_trees[value(settings[m], "maxIter")]
    return out


def few_partitions(train: DataFrame) -> DataFrame:
    """``train`` in partitions of about ``BOOST_ROWS`` rows. A boosting fit is hundreds of passes, and on small partitions most of a pass is
    the start of its tasks; the fits run side by side, so that few partitions each fill the cluster."""
    n = train.count()
    return train if n <= FOREST_ROWS else train.coalesce(math.ceil(n / BOOST_ROWS))


def staged_scores(family: str, make: Callable[[dict], object], tables: list[tuple[DataFrame, DataFrame]], settings: list[dict], *,
                  features: str, label: str, parallelism: int) -> np.ndarray:
    """RMSE [fold, setting] for (train, valid) tables per fold; ``make(setting)`` is the unfitted regressor."""
    out = np.empty((len(tables), len(settings)))
    jobs = [(i, fit, members) for i in range(len(tables)) for fit, members in shared_fits(family, settings)]
    spark = tables[0][0].sparkSession
    if family == "gbt":
        tables = [(few_partitions(train), valid) for train, valid in tables]
        parallelism = min(parallelism, BOOST_FITS)

    def one(job) -> None:
        i, fit, members = job
        train, valid = tables[i]
        out[i, members] = staged_rmse(family, make(fit).fit(train), valid, [settings[m] for m in members], features, label)

    with ThreadPool(min(parallelism, len(jobs))) as pool:
        pool.map(inheritable_thread_target(spark)(one), jobs, chunksize=1)
    return out
