"""Fitted Spark ML tree models as node tables: staged predictions and exact Shapley values.

``tree_tables`` reads a model's saved node table (one row per node: children, split, prediction, row count).
Both operators below score Arrow batches with numpy over whole trees at once; the rows stay distributed,
the model goes to the executors as it does when Spark ML scores it.

Shapley values are path-dependent: a feature outside the coalition sends a row down both branches in proportion to
the training rows there. For a leaf of value v whose path asks z_j (share of rows, multiplied over the path's splits
on feature j) and whether the row satisfies them, o_j in {0, 1}, the value of feature i is

    v (o_i - z_i)  integral over t in [0, 1] of  prod_{j != i} (z_j (1 - t) + o_j t)

since that integral is the sum of the coalition weights |S|! (m - |S| - 1)! / m!. The integrand is a polynomial, so
Gauss-Legendre nodes for its degree give it exactly. The values of a row sum to its prediction minus ``base``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path

EPSILON = 2.0 ** -52        # Spark ML takes a node of less impurity for pure
SPARK_DEPTH = 30            # the deepest tree that Spark ML grows
LOT = 100_000               # training rows whose subtrees a task grows, or one leaf's
NODE_BLOCK = 1 << 20        # nodes x features x bins held at once
LEAF_BLOCK = 1 << 21        # sets x leaves x features held at once
ROW_BLOCK = 2048            # rows looked up at once
ROWS_HELD = 1 << 15         # rows of a task whose Shapley values are worked out together


@dataclass
class Tree:
    """Arrays by node id; ``left`` is -1 at a leaf. A row goes left where its feature is at most the threshold."""
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    weight: float = 1.0

    def at_depths(self, x: np.ndarray, depths: list[int | None]) -> np.ndarray:
        """Predictions [rows, depths] of the tree cut at each depth (None: whole)."""
        out, node, d = np.empty((len(x), len(depths))), np.zeros(len(x), np.int64), 0
        while True:
            for i, stop in enumerate(depths):
                if stop == d:
                    out[:, i] = self.value[node]
            inner = self.left[node] >= 0
            if not inner.any():
                break
            go_left = x[np.arange(len(x)), self.feature[node]] <= self.threshold[node]
            node = np.where(inner, np.where(go_left, self.left[node], self.right[node]), node)
            d += 1
        for i, stop in enumerate(depths):
            if stop is None or stop > d:
                out[:, i] = self.value[node]
        return out

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf [rows] that each row ends in."""
        node = np.zeros(len(x), np.int64)
        while (self.left[node] >= 0).any():
            go_left = x[np.arange(len(x)), self.feature[node]] <= self.threshold[node]
            node = np.where(self.left[node] < 0, node, np.where(go_left, self.left[node], self.right[node]))
        return node

    def leaves(self, n_features: int) -> tuple[np.ndarray, ...]:
        """(value, low, high, z) of every leaf, the last three [leaf, feature]: its path asks low < x <= high."""
        todo = [(0, np.full(n_features, -np.inf), np.full(n_features, np.inf), np.ones(n_features))]
        out = []
        while todo:
            node, low, high, z = todo.pop()
            if self.left[node] < 0:
                out.append((self.value[node], low, high, z))
                continue
            f, t = self.feature[node], self.threshold[node]
            for child, is_left in ((self.left[node], True), (self.right[node], False)):
                a, b, share = low.copy(), high.copy(), z.copy()
                if is_left:
                    b[f] = min(b[f], t)
                else:
                    a[f] = max(a[f], t)
                share[f] *= self.cover[child] / self.cover[node]
                todo.append((child, a, b, share))
        return tuple(np.array(c) for c in zip(*out))


def _tree(rows: list, weight: float) -> Tree:
    n = len(rows)
    t = Tree(np.full(n, -1), np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n), weight)
    for r in rows:
        i = r["id"]
        t.value[i], t.cover[i] = r["prediction"], r["rawCount"]
        if r["leftChild"] >= 0:
            if r["split"]["numCategories"] != -1:
                raise ValueError("only splits of continuous features are supported")
            t.left[i], t.right[i] = r["leftChild"], r["rightChild"]
            t.feature[i], t.threshold[i] = r["split"]["featureIndex"], r["split"]["leftCategoriesOrThreshold"][0]
    return t


def tree_tables(spark: SparkSession, model) -> list[Tree]:
    """The trees of a fitted decision tree, forest or boosted model, with their weights in its prediction."""
    path = scratch_path(spark, "tree-model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    columns = ["id", "prediction", "rawCount", "leftChild", "rightChild", "split"]
    if "treeID" in nodes.columns:
        nodes = nodes.select("treeID", *[F.col(f"nodeData.{c}").alias(c) for c in columns])
        weights = [float(w) for w in model.treeWeights]
        if type(model).__name__.startswith("RandomForest"):
            weights = [w / sum(weights) for w in weights]       # a forest's prediction is the mean of its trees
    else:
        nodes, weights = nodes.select(F.lit(0).alias("treeID"), *columns), [1.0]
    per: dict[int, list] = {}
    for r in nodes.collect():       # the model itself: of the size that Spark ML broadcasts for scoring
        per.setdefault(r["treeID"], []).append(r)
    remove_path(spark, path)
    return [_tree(per[i], w) for i, w in enumerate(weights)]


def split_candidates(train: DataFrame, regressor, features: str, n_features: int) -> list[np.ndarray]:
    """The thresholds that Spark ML considers for each feature when it fits ``regressor`` (a decision tree's) to ``train``.
    They depend on the rows, the seed and the number of bins, not on the label: a tree fitted to a feature alone, with that
    feature as its label, splits at all of them."""
    spark, x = train.sparkSession, vector_to_array(features)
    means = train.select(x.alias("x")).agg(*[F.avg(F.nanvl(F.col("x")[j], F.lit(0.0))).alias(f"m{j}") for j in range(n_features)]).first()

    def one(j: int) -> np.ndarray:
        value = x[j]
        alone = train.select(array_to_vector(F.array(value)).alias("one"), (F.nanvl(value, F.lit(0.0)) - F.lit(means[j])).alias("same"))
        fit = regressor.copy({regressor.featuresCol: "one", regressor.labelCol: "same", regressor.maxDepth: 30,
                              regressor.minInstancesPerNode: 1}).fit(alone)
        (t,) = tree_tables(spark, fit)
        return np.unique(t.threshold[t.left >= 0])

    with ThreadPool(min(4, n_features)) as pool:
        return pool.map(inheritable_thread_target(spark)(one), range(n_features), chunksize=1)


def mixed(z: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number (the finisher of SplitMix64)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def asked_features(path: np.ndarray, k: int, n: int) -> np.ndarray:
    """[node, n] of the ``k`` features, ascending: those among which a node splits, drawn by the hash ``path`` of its place in the tree."""
    if n == k:
        return np.broadcast_to(np.arange(k), (len(path), k))
    keys = mixed(path[:, None] ^ mixed(np.arange(1, k + 1, dtype=np.uint64)))
    return np.sort(np.argsort(keys, axis=1, kind="stable")[:, :n], axis=1)


def child_paths(path: np.ndarray) -> np.ndarray:
    """[node, 2]: the hashes of the places of both children."""
    return mixed(path[:, None] * np.uint64(2) + np.array([1, 2], np.uint64))


def impurity(c: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Variance of labels with count ``c``, sum ``a`` and sum of squares ``b``; 0 without rows."""
    return np.divide(b - np.divide(a * a, c, out=np.zeros_like(a), where=c > 0), c, out=np.zeros_like(a), where=c > 0)


def best_splits(sums: np.ndarray, stats: np.ndarray, allowed: np.ndarray, min_rows: int) -> tuple[np.ndarray, ...]:
    """(nodes that split, feature slot, split, [3, child] of both children one after the other) of nodes with ``sums``
    [3, node, slot, bin] and ``stats`` [3, node], by Spark ML's rule; ``allowed`` [node or 1, slot, split]."""
    cum = np.cumsum(sums, axis=3)
    total, left = cum[..., -1:], cum[..., :-1]
    right = total - left
    share = left[0] / total[0]
    gain = impurity(*stats)[:, None, None] - share * impurity(*left) - right[0] / total[0] * impurity(*right)
    gain[~(allowed & (left[0] >= min_rows) & (right[0] >= min_rows)) | (gain < 0)] = -np.inf
    flat = gain.reshape(sums.shape[1], -1)
    best = flat.argmax(axis=1)
    ok = np.flatnonzero(flat[np.arange(len(flat)), best] > 0)
    f, t = np.divmod(best[ok], sums.shape[3] - 1)
    return ok, f, t, np.stack([left[:, ok, f, t], right[:, ok, f, t]], axis=2).reshape(3, -1)


def grow(bins: np.ndarray, root: np.ndarray, n: np.ndarray, s: np.ndarray, q: np.ndarray, bins2: np.ndarray, root2: np.ndarray,
         n_splits: list[int], min_rows: int, levels: int, path: np.ndarray | None = None, n_asked: int | None = None, kept: list | None = None):
    """Grows a tree below each root as Spark ML's variance trees grow, from rows given by their bins [row, feature] with count,
    sum and sum of squares of the label; yields after each level 0..``levels`` the predictions of the second rows
    (``bins2``, ``root2``), and stops once no node splits. Roots are numbered from 0 and each has a row of the first kind.
    With ``n_asked`` a node splits among that many features, drawn by its place below the root's ``path``. ``kept`` takes, level by
    level, the nodes that split with their left child (the right one is the next), feature and split, and the new nodes' values."""
    width, k = max(n_splits) + 1, len(n_splits)
    m = k if n_asked is None else n_asked
    allowed = np.arange(width - 1)[None, :] < np.array(n_splits)[:, None]      # [feature, split]
    size = int(root.max()) + 1
    path = np.zeros(size, np.uint64) if path is None else path                  # of the nodes of this level
    stats = np.array([np.bincount(root, v, size) for v in (n, s, q)])           # [3, node], all nodes so far
    value, at2 = stats[1] / stats[0], root2.copy()
    order = np.argsort(root, kind="stable")
    bins, node, rows = bins[order], root[order], np.array([n, s, q])[:, order]
    if kept is not None:
        kept.append((np.empty(0, np.int64),) * 3 + (np.empty(0, np.int64), value))
    yield value[at2]
    open_ = np.arange(size)
    is_open = np.abs(impurity(*stats)) >= EPSILON
    open_, path = open_[is_open], path[is_open]
    for _ in range(levels):
        keep = np.isin(node, open_)
        bins, node, rows = bins[keep], node[keep], rows[:, keep]
        if not len(node):
            return
        size = len(value)
        child, feature, split = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
        new, paths, first = [], [], size
        step = max(1, NODE_BLOCK // (m * width))
        for i in range(0, len(open_), step):
            mine = open_[i:i + step]
            a, b = np.searchsorted(node, [mine[0], mine[-1] + 1])
            at = np.searchsorted(mine, node[a:b])
            asked = asked_features(path[i:i + step], k, m)
            own = bins[a:b] if m == k else np.take_along_axis(bins[a:b], asked[at], axis=1)
            cell = (at[:, None] * m + np.arange(m)) * width + own
            sums = np.array([np.bincount(cell.ravel(), np.repeat(v, m), len(mine) * m * width) for v in rows[:, a:b]])
            ok, f, t, both = best_splits(sums.reshape(3, len(mine), m, width), stats[:, mine], allowed[None] if m == k else allowed[asked], min_rows)
            child[mine[ok]] = first + 2 * np.arange(len(ok))
            feature[mine[ok]], split[mine[ok]] = asked[ok, f], t
            new.append(both)
            paths.append(child_paths(path[i:i + step][ok]).ravel())
            first += 2 * len(ok)
        if first == size:
            return
        new, path = np.concatenate(new, axis=1), np.concatenate(paths)
        stats, value = np.concatenate([stats, new], axis=1), np.concatenate([value, new[1] / new[0]])
        if kept is not None:
            done = np.flatnonzero(child >= 0)
            kept.append((done, child[done], feature[done], split[done], value[size:]))
        down = lambda at, x: np.where(child[at] < 0, at, child[at] + (x[np.arange(len(at)), feature[at]] > split[at]))
        node = down(node, bins)
        order = np.argsort(node, kind="stable")
        bins, node, rows = bins[order], node[order], rows[:, order]
        moving = at2 < size
        at2[moving] = down(at2[moving], bins2[moving])
        yield value[at2]
        is_open = np.abs(impurity(*new)) >= EPSILON
        open_, path = size + np.flatnonzero(is_open), path[is_open]


def grown_errors(rows: DataFrame, train: Column, top: Tree, candidates: list[np.ndarray], depths: list[int | None], *, top_depth: int,
                 min_rows: int, features: str, label: str) -> list[float]:
    """RMSE, on the rows of ``rows`` that are not ``train``, of the tree of which ``top`` is the part down to ``top_depth``, cut
    at each of ``depths`` (all deeper than that). The leaves of ``top`` are dealt out in lots of about ``LOT`` rows; a task grows those
    of a lot on their rows (equal ones counted once) and scores the others, so that neither the driver nor a task holds the tree."""
    spark = rows.sparkSession
    leaves = np.flatnonzero(top.left < 0)
    lot = np.zeros(len(top.left), np.int64)
    lot[leaves] = np.cumsum(top.cover[leaves]) // LOT
    listed = spark.sparkContext.broadcast((top, candidates, lot))
    n_splits, deepest = [len(c) for c in candidates], max(SPARK_DEPTH if d is None else d for d in depths)

    @F.arrow_udf("struct<lot long, leaf long, bins binary>")
    def place(lists: pa.Array) -> pa.Array:
        top, candidates, lot = listed.value
        x = _matrix(lists)
        leaf = top.leaf(x) if len(x) else np.zeros(0, np.int64)
        bins = np.array([np.searchsorted(c, x[:, j]) if len(x) else [] for j, c in enumerate(candidates)]).T.astype(np.uint8)
        return pa.StructArray.from_arrays([pa.array(lot[leaf]), pa.array(leaf), pa.array([b.tobytes() for b in bins], pa.binary())],
                                          ["lot", "leaf", "bins"])

    def lots(pdf: pd.DataFrame) -> pd.DataFrame:
        bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), -1)
        known, root = np.unique(pdf["leaf"].to_numpy(), return_inverse=True)
        t = pdf["train"].to_numpy()
        n, s, q = (pdf[c].to_numpy(np.float64) for c in "nsq")
        if not t.any():
            return pd.DataFrame({"i": [], "n": [], "e": []})
        sse = lambda p: float((q[~t] - 2 * p * s[~t] + n[~t] * p * p).sum())
        level = []
        for p in grow(bins[t], root[t], n[t], s[t], q[t], bins[~t], root[~t], n_splits, min_rows, deepest - top_depth):
            level.append(sse(p))
        at = [level[min((SPARK_DEPTH if d is None else d) - top_depth, len(level) - 1)] for d in depths]
        return pd.DataFrame({"i": range(len(at)), "n": n[~t].sum(), "e": at})

    placed = rows.select(train.alias("train"), place(vector_to_array(features)).alias("p"), F.col(label).cast("double").alias("y"))
    points = placed.groupBy("p.lot", "p.leaf", "p.bins", "train").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    parts = points.groupBy("lot").applyInPandas(lots, "i int, n double, e double")
    found = {r["i"]: r["rmse"] for r in parts.groupBy("i").agg(F.sqrt(F.greatest(F.sum("e"), F.lit(0.0)) / F.sum("n")).alias("rmse")).collect()}
    return [float(found[i]) for i in range(len(depths))]


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def staged_predictions(features: Column, trees: list[Tree], stages: list[tuple[int, int | None]], spark: SparkSession) -> Column:
    """array<double>: for each stage (n trees, depth) the mean of the first n trees, cut at the depth."""
    listed = spark.sparkContext.broadcast((trees, stages))

    @F.arrow_udf("array<double>")
    def run(lists: pa.Array) -> pa.Array:
        trees, stages = listed.value
        x, depths = _matrix(lists), sorted({d for _, d in stages}, key=lambda d: (d is None, d))
        total, out = np.zeros((len(lists), len(depths))), np.empty((len(lists), len(stages)))
        for i, t in enumerate(trees, 1):
            total += t.at_depths(x, depths)
            for k, (n, d) in enumerate(stages):
                if n == i:
                    out[:, k] = total[:, depths.index(d)] / n
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * len(stages)), pa.array(out.ravel()))

    return run(vector_to_array(features))


def _leaf_values(o: np.ndarray, z: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley values [..., slot] of leaves of ``value`` whose path asks the features ``z`` of rows that satisfy ``o`` of them."""
    at, w = np.polynomial.legendre.leggauss(z.shape[-1] // 2 + 1)      # exact to degree 2 n - 1 >= slots - 1
    total = 0.0
    for t, weight in zip((at + 1) / 2, w / 2):
        term = z * (1 - t) + o * t          # positive, as every path has rows
        total = total + weight * term.prod(axis=-1, keepdims=True) / term
    return (o - z) * total * value[..., None]


def shapley(x: np.ndarray, leaves: tuple[np.ndarray, ...]) -> np.ndarray:
    """Exact Shapley values [row, feature] of one tree. A row's values for a leaf depend only on which of the m features on the
    leaf's path it satisfies; where there are fewer such sets than rows, they are worked out once a set and looked up."""
    value, low, high, z = leaves
    asked = np.isfinite(low) | np.isfinite(high)
    width, out = asked.sum(axis=1), np.zeros_like(x)
    cuts = [np.unique(np.concatenate([c[np.isfinite(c)] for c in (low[:, f], high[:, f])])) for f in range(x.shape[1])]
    codes = [np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]
    for m in np.unique(width[width > 0]):
        sets = 1 << int(m)
        table = sets <= max(len(x), 2)
        group = np.flatnonzero(width == m)
        step = max(1, LEAF_BLOCK // (min(sets, ROW_BLOCK) * x.shape[1]))
        for g in (group[i:i + step] for i in range(0, len(group), step)):
            slots = np.nonzero(asked[g])[1].reshape(len(g), m)
            zs = np.take_along_axis(z[g], slots, axis=1)
            each = np.arange(len(g))
            bit = np.zeros((len(g), x.shape[1]), np.int32)
            bit[each[:, None], slots] = 1 << np.arange(m)
            if table:
                o = ((np.arange(sets)[:, None] >> np.arange(m)) & 1).astype(float)
                by_set = np.zeros((len(g), sets, x.shape[1]))
                by_set[each[:, None, None], np.arange(sets)[None, :, None], slots[:, None, :]] = _leaf_values(o[None], zs[:, None], value[g][:, None])
            inside = []         # by feature: the bit [code, leaf] of rows in the leaf's interval
            for f in np.unique(slots):
                c = np.arange(len(cuts[f]) + 1)[:, None]
                a = np.where(np.isfinite(low[g, f]), np.searchsorted(cuts[f], low[g, f]) + 1, 0)
                b = np.where(np.isfinite(high[g, f]), np.searchsorted(cuts[f], high[g, f]), len(cuts[f]))
                inside.append((f, np.where((c >= a) & (c <= b), bit[:, f], 0).astype(np.int32)))
            for i in range(0, len(x), ROW_BLOCK):
                sat = np.zeros((len(x[i:i + ROW_BLOCK]), len(g)), np.int32)
                for f, bits in inside:
                    sat += bits[codes[f][i:i + ROW_BLOCK]]
                sat = np.ascontiguousarray(sat.T)
                part = out[i:i + ROW_BLOCK]
                if table:
                    got = np.empty_like(part)
                    for leaf in range(len(g)):
                        part += np.take(by_set[leaf], sat[leaf], axis=0, out=got, mode="clip")
                else:
                    for leaf in range(len(g)):
                        o = ((sat[leaf][:, None] >> np.arange(m)) & 1).astype(float)
                        part[:, slots[leaf]] += _leaf_values(o, zs[leaf][None], value[g[leaf]][None])
    return out


def base_value(trees: list[Tree]) -> float:
    """What a row without any known feature is predicted: the training mean of every tree."""
    total = 0.0
    for t in trees:
        value, _, _, z = t.leaves(int(t.feature.max(initial=0)) + 1)
        total += t.weight * float((value * z.prod(axis=1)).sum())
    return total


def tree_shap(features: Column, trees: list[Tree], n_features: int, spark: SparkSession) -> Column:
    """EXP-3: array<double>, the Shapley value of each feature for the model's prediction."""
    listed = spark.sparkContext.broadcast([(t.weight, t.leaves(n_features)) for t in trees])

    def values(held: list[np.ndarray]) -> Iterator[pa.Array]:
        x = np.concatenate(held)
        phi = np.zeros((len(x), n_features))
        for weight, leaves in listed.value if len(x) else ():
            phi += weight * shapley(x, leaves)
        for part in np.split(phi, np.cumsum([len(h) for h in held])[:-1]):
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * n_features), pa.array(part.ravel()))

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held: list[np.ndarray] = []
        for lists in batches:
            held.append(_matrix(lists).reshape(-1, n_features))
            if sum(map(len, held)) >= ROWS_HELD:
                yield from values(held)
                held = []
        if held:
            yield from values(held)

    return run(vector_to_array(features))


def mean_abs_shap(scored: DataFrame, model, names: list[str], features: str = "features") -> DataFrame:
    """feature, mean_abs_shap of a fitted tree model over all rows of ``scored``."""
    spark = scored.sparkSession
    scored = scored.select(features).repartition(2 * spark.sparkContext.defaultParallelism)      # much work a row: even tasks
    phi = scored.select(F.posexplode(tree_shap(F.col(features), tree_tables(spark, model), len(names), spark)).alias("j", "phi"))
    label = F.broadcast(spark.createDataFrame(list(enumerate(names)), "j int, feature string"))     # one row per feature
    return phi.groupBy("j").agg(F.avg(F.abs("phi")).alias("mean_abs_shap")).join(label, "j").select("feature", "mean_abs_shap")
