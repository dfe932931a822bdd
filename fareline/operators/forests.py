"""MOD-6: forests of many rows, grown and scored in tasks on Spark ML's split candidates and by its rule.

A tree's bootstrap sample (Poisson counts) is drawn by a hash of row and tree, the features among which a node splits by a hash of its
place, so that no draw depends on where or how often a task runs. Nodes of more than ``LEAF_ROWS`` drawn rows are split level by
level, all trees at once, on sums that tasks add up; below, each node is one group: a task grows it on its rows, and the rows to be scored
come to the groups in the same way; their predictions meet by row. The driver holds the splits of the large nodes, never the trees below them.

``forest_errors`` grows and scores in one go, for a search; ``ForestModel`` keeps its nodes as a table, one row per group."""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path
from . import trees as tr

LEAF_ROWS = 500_000         # drawn rows of a node up to which one task grows on


@dataclass
class Top:
    """The first levels of a tree by node; ``left`` is -1 where it was not split, the right child is the next node."""
    path: list
    left: list = field(default_factory=lambda: [-1])
    feature: list = field(default_factory=lambda: [0])
    split: list = field(default_factory=lambda: [0])
    depth: list = field(default_factory=lambda: [0])

    def place(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        left, feature, split = np.array(self.left), np.array(self.feature), np.array(self.split)
        while (inner := left[node] >= 0).any():
            right = bins[np.arange(len(bins)), feature[node]] > split[node]
            node = np.where(inner, left[node] + right, node)
        return node

    def divide(self, node: int, feature: int, split: int) -> tuple[int, int]:
        at = len(self.left)
        self.left[node], self.feature[node], self.split[node] = at, feature, split
        self.path += [int(p) for p in tr.child_paths(np.array([self.path[node]], np.uint64))[0]]
        self.left += [-1, -1]
        self.feature += [0, 0]
        self.split += [0, 0]
        self.depth += [self.depth[node] + 1] * 2
        return at, at + 1


def drawn(ids: np.ndarray, tree: int, seed: int, rate: float) -> np.ndarray:
    """How often each row is in the bootstrap sample of a tree: Poisson of mean ``rate``."""
    own, of_tree = tr.mixed(ids.astype(np.uint64) + tr.mixed(np.array([seed], np.uint64))), tr.mixed(np.array([~tree], np.int64).astype(np.uint64))
    u = (tr.mixed(own + of_tree) >> np.uint64(11)) * 2.0 ** -53
    chance = np.cumsum([math.exp(-rate) * rate ** i / math.factorial(i) for i in range(20)])
    return np.searchsorted(chance, u, side="right").astype(np.uint8)


def _points(batch: pa.RecordBatch, cuts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """id, is training row, label, bins [row, feature] of a batch."""
    x = tr._matrix(batch.column("x"))
    bins = np.array([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]).T.astype(np.uint8)
    return (batch.column("id").to_numpy(), batch.column("train").to_numpy(zero_copy_only=False), batch.column("y").to_numpy(), bins)


def _grow_tops(points: DataFrame, tops: list[Top], cuts: list[np.ndarray], levels: int, *, min_rows: int, n_asked: int, seed: int, rate: float) -> None:
    """Splits the nodes of more than ``LEAF_ROWS`` drawn rows, at most ``levels`` deep, a level of all trees a round."""
    sc, k, width = points.sparkSession.sparkContext, len(cuts), max(map(len, cuts)) + 1
    allowed = np.arange(width - 1)[None, :] < np.array([len(c) for c in cuts])[:, None]
    open_ = {(i, 0) for i in range(len(tops))}
    for _ in range(levels):
        listed = sc.broadcast((tops, cuts, open_))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops, cuts, open_ = listed.value
            held: dict = {}
            for batch in (b for b in batches if b.num_rows):
                ids, is_train, y, bins = _points(batch, cuts)
                ids, y, bins = ids[is_train], y[is_train], bins[is_train]
                for tree in sorted({t for t, _ in open_}):
                    w = drawn(ids, tree, seed, rate)
                    node = np.where(w > 0, tops[tree].place(bins), -1)
                    for at in (n for n in np.unique(node) if (tree, n) in open_):
                        r = np.flatnonzero(node == at)
                        asked = tr.asked_features(np.array([tops[tree].path[at]], np.uint64), k, n_asked)[0]
                        cell, v = (bins[r][:, asked] + np.arange(n_asked) * width).ravel(), w[r].astype(float)
                        part = np.array([np.bincount(cell, np.repeat(c, n_asked), n_asked * width) for c in (v, v * y[r], v * y[r] * y[r])])
                        held[tree, at] = held[tree, at] + part if (tree, at) in held else part
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in held], pa.int32()), pa.array([int(n) for _, n in held], pa.int32()),
                                                  pa.array([s.tobytes() for s in held.values()], pa.binary())], ["tree", "node", "sums"])

        def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            s = sum(np.frombuffer(b) for b in pdf["sums"]).reshape(3, 1, n_asked, width)
            asked = tr.asked_features(np.array([listed.value[0][key[0]].path[key[1]]], np.uint64), k, n_asked)
            stats = s[:, :, 0].sum(axis=2)
            if stats[0, 0] <= LEAF_ROWS or abs(tr.impurity(*stats)[0]) < tr.EPSILON:
                return pd.DataFrame({"tree": [], "node": [], "feature": [], "split": []})
            ok, f, t, _ = tr.best_splits(s, stats, allowed[asked], min_rows)
            return pd.DataFrame({"tree": key[0], "node": key[1], "feature": asked[ok, f], "split": t})

        found = points.mapInArrow(sums, "tree int, node int, sums binary").groupBy("tree", "node") \
            .applyInPandas(choose, "tree int, node int, feature int, split int").orderBy("tree", "node").collect()      # large nodes only
        open_ = {(r["tree"], c) for r in found for c in tops[r["tree"]].divide(r["node"], r["feature"], r["split"])}
        if not open_:
            return


DEALT = "tree int, node int, train boolean, block long, at binary, w binary, y binary, bins binary"


def _listed(data: DataFrame, train: Column, label: Column, features: str, row_id: Column | None = None) -> DataFrame:
    """The rows as tasks read them; of a written table: read again, its rows come in the same order."""
    return data.select((F.monotonically_increasing_id() if row_id is None else row_id).alias("id"), train.alias("train"),
                       label.cast("double").alias("y"), vector_to_array(features).alias("x"))


def _tops(points: DataFrame, cuts: list[np.ndarray], n_trees: int, levels: int, *, min_rows: int, n_asked: int, seed: int, rate: float) -> list[Top]:
    tops = [Top([int(tr.mixed(np.array([seed * 1_000_003 + i], np.int64).astype(np.uint64))[0])]) for i in range(n_trees)]
    if points.where("train").count() * rate > LEAF_ROWS:
        _grow_tops(points, tops, cuts, levels, min_rows=min_rows, n_asked=n_asked, seed=seed, rate=rate)
    return tops


def _dealt(points: DataFrame, listed: Broadcast, seed: int, rate: float, n_tasks: int) -> DataFrame:
    """The rows by tree and top node, those of a batch in one record: training rows as often as drawn, the others always."""
    names = [c.split()[0] for c in DEALT.split(", ")]
    types = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, cuts = listed.value
        for batch in (b for b in batches if b.num_rows):
            ids, is_train, y, bins = _points(batch, cuts)
            mine, other, out = np.flatnonzero(is_train), np.flatnonzero(~is_train), []
            for tree, top in enumerate(tops):
                w = np.zeros(len(ids), np.uint8)
                w[mine] = drawn(ids[mine], tree, seed, rate)
                for kind, which in ((True, np.flatnonzero(w)), (False, other)):
                    node = top.place(bins[which])
                    for at in np.unique(node):
                        r = which[node == at]
                        out.append((tree, int(at), kind, int(ids[0]), ids[r].tobytes(), w[r].tobytes(), y[r].tobytes(), bins[r].tobytes()))
            for i in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + 64]), types)], names)

    return points.mapInArrow(deal, DEALT).repartition(n_tasks, "tree", "node")


def _column(part: pd.DataFrame, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(part[name]), kind)


def _grown(rows: pd.DataFrame, other: np.ndarray, cuts: list[np.ndarray], path: int, levels: int, min_rows: int, n_asked: int, kept: list | None = None):
    """``tr.grow`` on a group's training rows."""
    bins = _column(rows, "bins", np.uint8).reshape(-1, len(cuts))
    w, y = _column(rows, "w", np.uint8).astype(float), _column(rows, "y", np.float64)
    return tr.grow(bins, np.zeros(len(bins), np.int64), w, w * y, w * y * y, other, np.zeros(len(other), np.int64), [len(c) for c in cuts], min_rows,
                   levels, np.array([path], np.uint64), n_asked, kept)


def _summed(pdf: pd.DataFrame, width: int) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """The ids of a block's rows, ascending, and after each tree the sums of the predictions so far [width, row]."""
    pdf = pdf.sort_values("tree", kind="stable")
    ids = np.sort(_column(pdf[pdf["tree"] == pdf["tree"].iloc[0]], "at", np.int64))

    def each() -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros((width, len(ids)))
        for tree, part in pdf.groupby("tree", sort=True):
            for at, p in zip(part["at"], part["p"]):
                total[:, np.searchsorted(ids, np.frombuffer(at, np.int64))] += np.frombuffer(p).reshape(width, -1)
            yield tree, total

    return ids, each()


def forest_errors(rows: DataFrame, train: Column, cuts: list[np.ndarray], stages: list[tuple[int, int]], *, min_rows: int, n_asked: int,
                  seed: int, rate: float, features: str, label: str) -> list[float]:
    """RMSE, on the rows of the written table ``rows`` that are not ``train``, of the forest's first n trees cut at a depth, for each
    stage (n, depth)."""
    spark, n_trees, depths = rows.sparkSession, max(n for n, _ in stages), sorted({d for _, d in stages})
    points = _listed(rows, train, F.col(label), features)
    tops = _tops(points, cuts, n_trees, min(depths), min_rows=min_rows, n_asked=n_asked, seed=seed, rate=rate)
    listed = spark.sparkContext.broadcast((tops, cuts))

    def grown(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tops, cuts = listed.value
        top, pdf = tops[key[0]], pdf.sort_values("block")
        a, b = pdf[pdf["train"]], pdf[~pdf["train"]]
        if b.empty:
            return pd.DataFrame({"block": [], "tree": [], "at": [], "y": [], "p": []})
        want = [d - top.depth[key[1]] for d in depths]
        got = [np.empty(0)] * len(depths)
        for level, p in enumerate(_grown(a, _column(b, "bins", np.uint8).reshape(-1, len(cuts)), cuts, top.path[key[1]], max(want), min_rows, n_asked)):
            got = [p if level <= d else g for d, g in zip(want, got)]
        ends = np.cumsum([len(v) // 8 for v in b["at"]])[:-1]
        return pd.DataFrame({"block": b["block"].to_numpy(), "tree": key[0], "at": list(b["at"]), "y": list(b["y"]),
                             "p": [part.tobytes() for part in np.split(np.array(got), ends, axis=1)]})

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, each = _summed(pdf, len(depths))
        y, sse = np.zeros(len(ids)), np.zeros(len(stages))
        first = pdf[pdf["tree"] == pdf["tree"].min()]
        y[np.searchsorted(ids, _column(first, "at", np.int64))] = _column(first, "y", np.float64)
        for tree, total in each:
            for i, (n, d) in enumerate(stages):
                if n == tree + 1:
                    sse[i] = ((total[depths.index(d)] / n - y) ** 2).sum()
        return pd.DataFrame({"i": range(len(stages)), "n": float(len(ids)), "e": sse})

    groups = _dealt(points, listed, seed, rate, _tasks(spark, n_trees)).groupBy("tree", "node")
    scored = groups.applyInPandas(grown, "block long, tree int, at binary, y binary, p binary")
    parts = scored.groupBy("block").applyInPandas(met, "i int, n double, e double")
    found = {r["i"]: r["rmse"] for r in parts.groupBy("i").agg(F.sqrt(F.sum("e") / F.sum("n")).alias("rmse")).collect()}
    return [float(found[i]) for i in range(len(stages))]


def _tasks(spark, n_trees: int) -> int:
    return max(4 * spark.sparkContext.defaultParallelism, n_trees)


def candidates(train: DataFrame, forest: RandomForestRegressor, features: str, label: str) -> list[np.ndarray]:
    """The thresholds that Spark ML considers for each feature when it fits ``forest`` to ``train``; they are those of a single tree."""
    n = train.select(F.size(vector_to_array(features))).first()[0]
    tree = DecisionTreeRegressor(featuresCol=features, labelCol=label, seed=forest.getOrDefault("seed"), maxBins=forest.getOrDefault("maxBins"))
    return tr.split_candidates(train, tree, features, n)


def draws(forest: RandomForestRegressor, n_features: int) -> dict:
    """What of ``forest`` the draws depend on: rows of a tree and, a third of them, features of a node."""
    return {"seed": forest.getOrDefault("seed"), "rate": forest.getOrDefault("subsamplingRate"), "n_asked": math.ceil(n_features / 3)}


# --- a fitted forest as a table ---------------------------------------------------------

NODES = "tree int, node int, child binary, feature binary, split binary, value binary"


class ForestModel(Model, MLReadable, MLWritable):
    """A fitted forest: ``nodes`` names a table with the nodes of each group (``NODES``), ``state`` holds the large nodes and thresholds.
    A row is scored where the nodes are; neither the driver nor a task holds the forest."""
    state = Param(Params._dummy(), "state", "tops and thresholds (JSON)", TypeConverters.toString)
    nodes = Param(Params._dummy(), "nodes", "folder of the node table", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state="{}", nodes="", featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._setDefault(state="{}", nodes="", featuresCol="features", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Writes the rows first: they are read by number twice, to be scored and to be joined with their predictions."""
        spark, path = dataset.sparkSession, scratch_path(dataset.sparkSession, "to-score")
        numbered = dataset.withColumn("_row", F.monotonically_increasing_id())
        numbered.write.parquet(path)
        rows = spark.read.schema(numbered.schema).parquet(path)
        state = json.loads(self.getOrDefault("state"))
        tops, cuts = [Top(**t) for t in state["tops"]], [np.array(c) for c in state["cuts"]]
        listed, n_tasks = spark.sparkContext.broadcast((tops, cuts)), _tasks(spark, len(tops))
        points = _listed(rows, F.lit(False), F.lit(0.0), self.getOrDefault("featuresCol"), F.col("_row"))
        name, n_trees, k = self.getOrDefault("predictionCol"), len(tops), len(cuts)

        def score(nodes: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
            if nodes.empty or pdf.empty:
                return pd.DataFrame({"block": [], "tree": [], "at": [], "p": []})
            child, feature, split, value = (np.frombuffer(nodes[c].iloc[0], t) for c, t in
                                            (("child", np.int32), ("feature", np.int32), ("split", np.uint8), ("value", np.float64)))
            out = []
            for record in pdf["bins"]:
                bins = np.frombuffer(record, np.uint8).reshape(-1, k)
                at, every = np.zeros(len(bins), np.int64), np.arange(len(bins))
                while (inner := child[at] >= 0).any():
                    at = np.where(inner, child[at] + (bins[every, feature[at]] > split[at]), at)
                out.append(value[at].tobytes())
            return pd.DataFrame({"block": pdf["block"], "tree": pdf["tree"], "at": pdf["at"], "p": out})

        def met(pdf: pd.DataFrame) -> pd.DataFrame:
            ids, each = _summed(pdf, 1)
            *_, (_, total) = each
            return pd.DataFrame({"_row": ids, name: total[0] / n_trees})

        nodes = spark.read.schema(NODES).parquet(self.getOrDefault("nodes")).repartition(n_tasks, "tree", "node")
        scored = nodes.groupBy("tree", "node").cogroup(_dealt(points, listed, 0, 0.0, n_tasks).groupBy("tree", "node")) \
            .applyInPandas(score, "block long, tree int, at binary, p binary")
        return rows.join(scored.groupBy("block").applyInPandas(met, f"_row long, {name} double"), "_row").drop("_row")

    def write(self) -> "_Writer":
        return _Writer(self)

    @classmethod
    def read(cls) -> "_Reader":
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.sparkSession.read.schema(NODES).parquet(self.model.getOrDefault("nodes")).write.parquet(os.path.join(path, "nodes"))


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ForestModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._set(nodes=os.path.join(path, "nodes"))


def fit_forest(data: DataFrame, forest: RandomForestRegressor) -> ForestModel:
    """The fit of ``forest``, grown in tasks, its nodes written under the shared checkpoint folder."""
    spark, features, label = data.sparkSession, forest.getOrDefault("featuresCol"), forest.getOrDefault("labelCol")
    path = scratch_path(spark, "forest-rows")
    data.select(features, label).write.parquet(path)
    rows = spark.read.schema(data.select(features, label).schema).parquet(path)
    cuts = candidates(rows, forest, features, label)
    n_trees, depth, min_rows = (forest.getOrDefault(p) for p in ("numTrees", "maxDepth", "minInstancesPerNode"))
    drawn_by = draws(forest, len(cuts))
    seed, rate, n_asked = (drawn_by[p] for p in ("seed", "rate", "n_asked"))
    points = _listed(rows, F.lit(True), F.col(label), features)
    tops = _tops(points, cuts, n_trees, depth, min_rows=min_rows, **drawn_by)
    listed = spark.sparkContext.broadcast((tops, cuts))

    def nodes(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tops, cuts = listed.value
        top, kept = tops[key[0]], []
        for _ in _grown(pdf.sort_values("block"), np.empty((0, len(cuts)), np.uint8), cuts, top.path[key[1]], depth - top.depth[key[1]], min_rows, n_asked, kept):
            pass
        value = np.concatenate([v for *_, v in kept])
        child, feature, split = np.full(len(value), -1, np.int32), np.zeros(len(value), np.int32), np.zeros(len(value), np.uint8)
        for at, c, f, t, _ in kept:
            child[at], feature[at], split[at] = c, f, t
        return pd.DataFrame({"tree": [key[0]], "node": [key[1]], "child": [child.tobytes()], "feature": [feature.tobytes()], "split": [split.tobytes()],
                             "value": [value.tobytes()]})

    table = scratch_path(spark, "forest-nodes")
    _dealt(points, listed, seed, rate, _tasks(spark, n_trees)).groupBy("tree", "node").applyInPandas(nodes, NODES).write.parquet(table)
    remove_path(spark, path)
    state = json.dumps({"tops": [asdict(t) for t in tops], "cuts": [c.tolist() for c in cuts]})
    return ForestModel(state=state, nodes=table, featuresCol=features, predictionCol=forest.getOrDefault("predictionCol"))
