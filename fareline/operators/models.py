"""Model fitting, search, comparison, explanation and calibration on Spark ML.

Preprocessing (PP-1..PP-6) is fitted once on the train split as small
parameter tables and applied as Column expressions before a
``VectorAssembler``; the regressors are Spark ML's distributed trainers
(linear: normal equations / L-BFGS / OWL-QN; trees: binned, sub-sampled
tree aggregation). The search (``search``) uses a stable hash fold column, never
``randomSplit``.
"""

from __future__ import annotations

import functools
import json
import operator
import os
from contextlib import contextmanager, nullcontext
from dataclasses import asdict, dataclass, field, replace
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CV_FOLDS, RANDOM_STATE, SEARCH_ITERS, SELECTION_TIERS
from ..session import remove_path, scratch_path
from . import forests as fo
from . import isotonic as iso
from . import metrics as met
from . import prep as pp
from . import quantiles as qt
from . import search as sr
from . import trees as tr


# --- PP-6 preprocessing -------------------------------------------------------

@dataclass
class Preprocessor:
    """Fitted column transformer: ordinal codes + clip (+ Yeo-Johnson + scale) + binary passthrough.

    Output order: ordinal, skewed, non-skewed, binary (as the reference)."""
    ordinal: list = field(default_factory=list)
    skewed: list = field(default_factory=list)
    other: list = field(default_factory=list)
    binary: list = field(default_factory=list)
    scaled: bool = True
    clip: dict = field(default_factory=dict)
    lambdas: dict = field(default_factory=dict)
    standard: dict = field(default_factory=dict)
    codes: dict = field(default_factory=dict)   # column -> {value as text: code}
    text_ordinal: list = field(default_factory=list)   # ordinal columns whose values are strings

    @property
    def feature_order(self) -> list:
        return self.ordinal + self.skewed + self.other + self.binary

    def columns(self) -> dict:
        out = {}
        for c in self.skewed + self.other:
            x = pp.clip_expr(c, tuple(self.clip.get(c, (None, None))))
            if self.scaled:
                if c in self.skewed:
                    x = pp.yeo_johnson(x, self.lambdas.get(c, 1.0))
                m, s = self.standard[c]
                x = (x - F.lit(m)) / F.lit(s)
            out[f"_pp_{c}"] = x.cast("double")
        for c in self.binary:
            out[f"_pp_{c}"] = F.col(c).cast("double")
        return out

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Ordinal codes come from Spark ML's label lookup (a hash table per
        column, whatever the dictionary's size; unknown and null -> -1)."""
        tmp, drop = df.withColumns(self.columns()), []
        for c in self.ordinal:
            labels = [v for v, _ in sorted(self.codes.get(c, {}).items(), key=lambda kv: kv[1])]
            key = F.col(c).cast("string") if c in self.text_ordinal else F.col(c).cast("double").cast("string")
            k, i = f"_ppk_{c}", f"_ppi_{c}"
            tmp = tmp.withColumn(k, key)
            if labels:
                tmp = StringIndexerModel.from_labels(labels, inputCol=k, outputCol=i, handleInvalid="keep").transform(tmp)
            else:
                tmp = tmp.withColumn(i, F.lit(0.0))
            tmp = tmp.withColumn(f"_pp_{c}", F.when(F.col(i) >= len(labels), F.lit(-1.0)).otherwise(F.col(i)))
            drop += [k, i]
        va = VectorAssembler(inputCols=[f"_pp_{c}" for c in self.feature_order], outputCol=output,
                             handleInvalid="keep")
        return va.transform(tmp).drop(*drop, *[f"_pp_{c}" for c in self.feature_order])

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "Preprocessor":
        return cls(**json.loads(text))


def fit_preprocessor(train: DataFrame, ordinal, continuous, binary, *, scaled: bool = True) -> Preprocessor:
    """Fit PP-1..PP-5 on the train split (a handful of aggregates)."""
    continuous = list(continuous)
    skewed, other, _ = pp.skew_split(train, continuous)
    clip = pp.fit_clip(train, continuous) if continuous else {}
    prep = Preprocessor(ordinal=list(ordinal), skewed=skewed, other=other, binary=list(binary), scaled=scaled,
                        clip={k: list(v) for k, v in clip.items()})
    if ordinal:
        d = (pp.fit_ordinal(train, ordinal)      # the distinct values of the ordinal columns, as Spark's text
             .withColumn("value", F.coalesce("str_value", F.col("num_value").cast("string"))).collect())
        for r in d:
            if r["num_value"] is None and r["feature"] not in prep.text_ordinal:
                prep.text_ordinal.append(r["feature"])
            prep.codes.setdefault(r["feature"], {})[r["value"]] = r["code"]
    if scaled and continuous:
        clipped = pp.apply_clip(train, clip)
        prep.lambdas = pp.fit_yeo_johnson(clipped, skewed) if skewed else {}
        transformed = clipped.withColumns({c: pp.yeo_johnson(c, prep.lambdas[c]) for c in skewed})
        std = pp.fit_standard(transformed, continuous)
        prep.standard = {c: list(v) for c, v in std.items()}
    return prep


# --- PP-6 as a Spark ML stage (refitted per CV fold inside a Pipeline) ----------

from pyspark import keyword_only  # noqa: E402
from pyspark.ml import Estimator, Model  # noqa: E402
from pyspark.ml.param import Param, Params, TypeConverters  # noqa: E402
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable  # noqa: E402


class _PrepParams(Params):
    ordinalCols = Param(Params._dummy(), "ordinalCols", "ordinal columns", TypeConverters.toListString)
    continuousCols = Param(Params._dummy(), "continuousCols", "continuous columns", TypeConverters.toListString)
    binaryCols = Param(Params._dummy(), "binaryCols", "binary columns", TypeConverters.toListString)
    scaled = Param(Params._dummy(), "scaled", "clip + Yeo-Johnson + scale (else clip only)", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)


class TripPreprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """PP-6 as an ML Estimator: ``fit`` runs the PP-1..PP-5 aggregates on the
    data it is given (so a CrossValidator refits it on each training fold),
    the model applies them as Column expressions + VectorAssembler."""

    @keyword_only
    def __init__(self, *, ordinalCols=(), continuousCols=(), binaryCols=(), scaled=True, outputCol="features"):
        super().__init__()
        self._setDefault(ordinalCols=[], continuousCols=[], binaryCols=[], scaled=True, outputCol="features")
        self._set(**{k: (list(v) if isinstance(v, tuple) else v) for k, v in self._input_kwargs.items()})

    def _fit(self, dataset):
        prep = fit_preprocessor(dataset, self.getOrDefault("ordinalCols"), self.getOrDefault("continuousCols"),
                                self.getOrDefault("binaryCols"), scaled=self.getOrDefault("scaled"))
        m = TripPreprocessorModel(state=prep.to_json(), outputCol=self.getOrDefault("outputCol"))
        return m


class TripPreprocessorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted preprocessing parameters (JSON)", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state="{}", outputCol="features"):
        super().__init__()
        self._setDefault(state="{}", outputCol="features")
        self._set(**self._input_kwargs)

    def preprocessor(self) -> Preprocessor:
        return Preprocessor.from_json(self.getOrDefault("state"))

    def _transform(self, dataset):
        return self.preprocessor().transform(dataset, self.getOrDefault("outputCol"))


# --- MOD-1..4 model families -------------------------------------------------

def make_regressor(family: str, params: dict | None = None, label: str = "fare_amount", seed: int = 42):
    params = dict(params or {})
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction"}
    if family == "linear":
        return LinearRegression(**common, **{"regParam": 0.0, "elasticNetParam": 0.0, **params})
    if family == "tree":
        return DecisionTreeRegressor(**common, seed=seed, **{"maxDepth": 10, "minInstancesPerNode": 1, **params})
    if family == "forest":
        # the same forest; without the cached node ids every row walks down all trees from the root once a level
        return RandomForestRegressor(**common, seed=seed, **{"numTrees": 100, "maxDepth": 10, "subsamplingRate": 0.3,
                                                             "cacheNodeIds": True, **params})
    if family == "gbt":
        return GBTRegressor(**common, seed=seed, **{"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, **params})
    raise ValueError(f"unknown model family {family!r}")


def fit_regressor(family: str, params: dict | None, data: DataFrame) -> PipelineModel:
    """One regressor fitted to preprocessed rows. Spark ML holds a forest's nodes on the driver: one that is deeper than a search's
    first levels, of more rows than a search gives it whole, is grown in tasks and stays a table (``forests``)."""
    regressor = make_regressor(family, params)
    if family == "forest" and regressor.getOrDefault("maxDepth") > sr.TOP and data.count() > sr.FOREST_ROWS:
        return PipelineModel([fo.fit_forest(data, regressor)])
    return Pipeline(stages=[regressor]).fit(data)


# Search space of each family (fixed values; the deepest tree that Spark ML grows stands for an unlimited one).
GRIDS = {
    "linear": {"regParam": [0.0, 0.001, 0.01, 0.1, 1.0, 10.0, 50.0], "elasticNetParam": [0.0, 0.2, 0.5, 0.8, 1.0]},
    "tree": {"maxDepth": [5, 10, 20, 30], "minInstancesPerNode": [1, 2, 4]},
    "forest": {"numTrees": [100, 200], "maxDepth": [10, 15, 20], "minInstancesPerNode": [2, 4]},
    "gbt": {"maxIter": [80, 150], "stepSize": [0.05, 0.1], "maxDepth": [3, 4], "subsamplingRate": [0.5, 0.8]},
}


@contextmanager
def fold_tables(data: DataFrame, folds: int, seed: int, label: str, preprocessor: "TripPreprocessor | None" = None,
                parallelism: int = 5):
    """What a search reads. Without a preprocessor: one written table (``_fold``, ``features``, label). With one: a table per fold,
    the preprocessing fitted on that fold's training rows only (no leakage from the validation fold), with
    ``features`` (clipped, for trees) and ``scaled`` (for linear models). All families of a search share them."""
    spark, d = data.sparkSession, data.withColumn("_fold", pp.kfold(k=folds, seed=str(seed)))
    paths: list[str] = []

    def write(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "fold")
        paths.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def one(i: int) -> DataFrame:
        get = preprocessor.getOrDefault
        prep = fit_preprocessor(d.where(F.col("_fold") != i), get("ordinalCols"), get("continuousCols"), get("binaryCols"), scaled=True)
        both = replace(prep, scaled=False).transform(prep.transform(d, "scaled"))
        return write(both.select("_fold", "scaled", "features", label))

    try:
        if preprocessor is None:
            yield [write(d.select("_fold", "features", label))]
        else:
            with ThreadPool(min(parallelism, folds)) as pool:
                yield pool.map(inheritable_thread_target(spark)(one), range(folds))
    finally:
        for path in paths:
            remove_path(spark, path)


def search_family(family: str, tables: list[DataFrame], settings: list[dict], folds: int, *, seed: int = RANDOM_STATE,
                  label: str = "fare_amount", parallelism: int = 8) -> np.ndarray:
    """RMSE [fold, setting] of one family over the tables of ``fold_tables``."""
    per_fold = len(tables) > 1
    if family == "linear":
        vector = "scaled" if "scaled" in tables[0].columns else "features"
        found = [sr.fold_moments(t, vector, label, "_fold") for t in tables]

        def split(i: int):
            each = found[i if per_fold else 0]
            return functools.reduce(operator.add, (m for f, m in each.items() if f != i)), each[i]

        return sr.linear_scores(split, folds, settings)
    folded = [(t, F.col("_fold") != i) for i, t in enumerate(tables * (1 if per_fold else folds))]
    scores = {"tree": sr.tree_scores, "forest": sr.forest_scores, "gbt": sr.boosting_scores}[family]
    return scores(lambda s: make_regressor(family, s, label, seed), folded, settings, features="features", label=label, parallelism=parallelism)


def tune(family: str, data: DataFrame, *, n_iter: int = SEARCH_ITERS, folds: int = CV_FOLDS, seed: int = RANDOM_STATE,
         label: str = "fare_amount", preprocessor: "TripPreprocessor | None" = None, tables: list[DataFrame] | None = None) -> list[tuple]:
    """MOD-6 of one family: (setting, mean, population std of the folds' RMSE) of a seeded sample of its grid over stable hash
    folds. ``data`` is preprocessed (``features``), or is not and ``preprocessor`` is refitted in every training fold;
    ``tables`` are those of an open ``fold_tables`` that families share."""
    settings = sr.draw(GRIDS[family], n_iter, seed)
    with nullcontext(tables) if tables else fold_tables(data, folds, seed, label, preprocessor) as ready:
        scores = search_family(family, ready, settings, folds, seed=seed, label=label)
    return [(s, float(a), float(b)) for s, a, b in zip(settings, scores.mean(axis=0), scores.std(axis=0))]


def cv_scores(family: str, data: DataFrame, *, folds: int = CV_FOLDS, seed: int = RANDOM_STATE, params: dict | None = None,
              label: str = "fare_amount", parallelism: int = 5) -> tuple[float, float]:
    """MOD-7: (mean, population std) of the RMSE over hash folds; the folds are
    independent Spark jobs, run side by side."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    d = data.withColumn("_fold", pp.kfold(k=folds, seed=str(seed)))

    def one(i: int) -> float:
        model = make_regressor(family, params, label, seed).fit(d.where(F.col("_fold") != i))
        return ev.evaluate(model.transform(d.where(F.col("_fold") == i)))

    with ThreadPool(min(parallelism, folds)) as pool:
        scores = pool.map(inheritable_thread_target(data.sparkSession)(one), range(folds))
    mean = sum(scores) / folds
    return mean, (sum((s - mean) ** 2 for s in scores) / folds) ** 0.5


# --- MOD-7 / MOD-8 ---------------------------------------------------------------

def comparison_table(pred_long: DataFrame, *, n_features: int = 10, cv: DataFrame | None = None) -> DataFrame:
    """MOD-7 from a long prediction table (model, split in {train,test}, actual, predicted):
    train / test R2, gap, test RMSE / MAE / MAPE, adjusted R2, within-15%,
    all rounded to 4 - one grouped aggregate + pivot. ``cv`` adds
    (model, cv_mean_rmse, cv_std_rmse)."""
    m = met.regression_metrics(pred_long, "actual", "predicted", n_features=n_features, by=["model", "split"])
    of = lambda split, c: F.max(F.when(F.col("split") == split, F.col(c)))  # noqa: E731      one row per model and split
    names = {"test_r2": "r2", "test_rmse": "rmse", "test_mae": "mae", "test_mape": "mape", "adjusted_r2": "adjusted_r2",
             "within_15pct_acc": "within_tol"}
    t = (m.where(F.col("model").isNotNull() & F.col("split").isin("train", "test")).groupBy("model")
         .agg(F.count(F.lit(1)).alias("_splits"), of("train", "r2").alias("train_r2"), *[of("test", c).alias(k) for k, c in names.items()])
         .where(F.col("_splits") == 2).withColumn("train_test_gap", F.abs(F.col("train_r2") - F.col("test_r2"))))
    if cv is not None:
        t = t.join(cv, "model", "left")
    else:
        t = t.withColumns({"cv_mean_rmse": F.lit(None).cast("double"), "cv_std_rmse": F.lit(None).cast("double")})
    cols = ["train_r2", "test_r2", "train_test_gap", "cv_mean_rmse", "cv_std_rmse", "test_rmse", "test_mae",
            "test_mape", "adjusted_r2", "within_15pct_acc"]
    return t.select("model", *[F.round(c, 4).alias(c) for c in cols])


def select_best(summary: DataFrame, tiers=SELECTION_TIERS) -> DataFrame:
    """MOD-8: first tier (gap, cv_std/cv_mean, min R2) with candidates, best by
    (rmse asc, r2 desc); a NULL gap / cv or cv_mean 0 never qualifies; no
    candidate in any tier -> the overall best row."""
    ratio = F.try_divide(F.col("cv_std_rmse"), F.when(F.col("cv_mean_rmse") != 0, F.col("cv_mean_rmse")))
    tier = None
    for i, (gap, cvr, r2) in enumerate(tiers):
        ok = (F.col("train_test_gap").isNotNull() & F.col("cv_std_rmse").isNotNull()
              & (F.col("train_test_gap") <= gap) & F.coalesce(ratio <= cvr, F.lit(False)) & (F.col("test_r2") >= r2))
        tier = F.when(ok, F.lit(i)) if tier is None else tier.when(ok, F.lit(i))
    t = summary.withColumn("tier", tier.otherwise(F.lit(len(tiers))))
    return t.orderBy("tier", "test_rmse", F.desc("test_r2"), "model").limit(1)


# --- EXP-* -------------------------------------------------------------------------

def feature_importance(model, names, top_k: int = 20):
    """EXP-1: tree importances, else |coefficients|; top k as (feature, importance)."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray()
    else:
        vals = [abs(x) for x in model.coefficients.toArray()]
    pairs = sorted(zip(names, [float(x) for x in vals]), key=lambda t: -t[1])
    return pairs[:top_k]


def shuffled_columns(df: DataFrame, columns, seed: int, rows_per_block: int = 10_000, n_rows: int | None = None,
                     drawn_from=None) -> DataFrame:
    """``df`` with, for each of ``columns``, a column ``_s_<name>`` that holds its values shuffled over the rows.

    Rows fall into hash blocks of about ``rows_per_block`` rows and are ordered in a
    block by another hash of the whole row; each takes the values of the next one (the
    last of the first), a random cycle. One window for all columns, no global sort, no
    single task. The draws are seeded hashes of the row, not ``rand``: a
    partition recomputed after an executor loss gets the same ones, and even a
    key shared by a third of all rows is spread over all blocks. ``drawn_from``: the columns hashed (default: all)."""
    n_rows = n_rows if n_rows is not None else df.count()
    row = [F.col(c) for c in drawn_from or df.columns]
    base = df.withColumns({"_blk": F.pmod(F.xxhash64(F.lit(seed), *row), F.lit(max(1, n_rows // rows_per_block))),
                           "_ord": F.xxhash64(F.lit(seed + 1), *row)})
    values = F.struct(*columns)
    w = Window.partitionBy("_blk").orderBy("_ord", *columns)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = F.coalesce(F.lead(values).over(w), F.first(values).over(whole))
    out = base.withColumn("_next", nxt)
    return out.withColumns({f"_s_{c}": F.col(f"_next.{c}") for c in columns}).drop("_blk", "_ord", "_next")


def permutation_importance(fitted: PipelineModel, prep: Preprocessor, df: DataFrame, columns, *, repeats: int = 5,
                           label: str = "fare_amount", seed: int = 42):
    """EXP-2: mean increase of RMSE when one input column is shuffled (repeats).

    Every output of the preprocessing reads one input, so shuffling an input shuffles that output: rows are preprocessed once and
    written, a repeat moves their vectors. One job per repeat: every row is scored once as it is and once per column with
    that column's shuffled value."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    columns, used = list(columns), list(prep.feature_order)
    sums, at = dict.fromkeys(columns, 0.0), [used.index(c) for c in columns]
    ready = prep.transform(df.select(label, *used), "_x")
    with qt.kept(ready.select(label, *used, vector_to_array("_x").alias("_x"))) as base:
        n = base.count()
        for r in range(repeats):
            s = shuffled_columns(base, ["_x"], seed + 10 * r, n_rows=n, drawn_from=[label, *used])
            each = s.select(label, "_x", "_s__x", F.explode(F.array(*map(F.lit, [-1, *at]))).alias("shuffled"))
            x = F.array(*[F.when(F.col("shuffled") == i, F.col("_s__x")[i]).otherwise(F.col("_x")[i]) for i in range(len(used))])
            scored = fitted.transform(each.select(label, "shuffled", array_to_vector(x).alias("features")))
            e = F.col("prediction") - F.col(label)
            rmse = {v["shuffled"]: v["rmse"] for v in scored.groupBy("shuffled").agg(F.sqrt(F.avg(e * e)).alias("rmse")).collect()}
            for c, i in zip(columns, at):
                sums[c] += rmse[i] - rmse[-1]
    return sorted(((c, v / repeats) for c, v in sums.items()), key=lambda t: (-t[1], t[0]))


def vector_shap(scored: DataFrame, coefficients, names, features: str = "features") -> DataFrame:
    """EXP-3 on a feature vector: mean |coef_j (x_j - mean_j)| per feature, all rows, two aggregates."""
    from pyspark.ml.functions import vector_to_array

    x = scored.select(F.posexplode(vector_to_array(features)).alias("j", "x"))
    means = x.groupBy("j").agg(F.avg("x").alias("m"))       # one row per feature
    t = scored.sparkSession.createDataFrame([(i, n, float(c)) for i, (n, c) in enumerate(zip(names, coefficients))],
                                            "j int, feature string, coef double")
    per = F.broadcast(means.join(t, "j"))
    return x.join(per, "j").groupBy("feature").agg(F.avg(F.abs(F.col("coef") * (F.col("x") - F.col("m")))).alias("mean_abs_shap"))


def attributions(scored: DataFrame, model, names, features: str = "features") -> DataFrame:
    """EXP-3: feature, mean_abs_shap over all rows, exact for linear and tree models alike."""
    if hasattr(model, "coefficients"):
        return vector_shap(scored, model.coefficients.toArray(), names, features)
    return tr.mean_abs_shap(scored, model, list(names), features)


def linear_shap(df: DataFrame, coefs: dict) -> DataFrame:
    """EXP-3 (linear models, exact): mean |coef_j (x_j - mean_j)| per feature, all rows."""
    cols = list(coefs)
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    a = df.agg(*[F.avg(F.abs(F.lit(coefs[c]) * (F.col(c) - F.lit(means[c])))).alias(c) for c in cols])
    return a.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_shap"))
                                       for c in cols])))


# --- CAB-* ---------------------------------------------------------------------------

@dataclass
class Calibration:
    k: float
    coverage: float
    empirical_coverage: float
    model_path: str | None = None


def calibrate(scored_cal: DataFrame, *, label: str = "fare_amount", prediction: str = "prediction",
              coverage: float = 0.90) -> tuple[iso.IsotonicFit, Calibration]:
    """CAB-1/CAB-2: isotonic fit of |residual| on prediction over all rows (increasing, clipped outside the range),
    k = exact quantile(|res| / max(iso(pred), 1e-6), coverage), empirical coverage = mean(|res| <= k iso(pred))."""
    d = scored_cal.select(F.col(prediction).cast("double").alias("p"), F.abs(F.col(label) - F.col(prediction)).alias("r"))
    with qt.kept(d.where("p IS NOT NULL AND r IS NOT NULL")) as rows:       # read by every pass; the model scores once
        fit = iso.isotonic_fit(rows, "p", "r")
        with qt.kept(rows.select("r", fit.predict(F.col("p")).alias("w"))) as w:
            ratio = w.select((F.col("r") / F.greatest("w", F.lit(1e-6))).alias("ratio"))
            k = qt.quantile_values(ratio, ["ratio"], [coverage])[((), "ratio", coverage)]
            emp = w.agg(F.avg((F.col("r") <= F.lit(k) * F.col("w")).cast("double"))).first()[0]
    return fit, Calibration(k=float(k), coverage=coverage, empirical_coverage=float(emp))


def predict_with_interval(scored: DataFrame, fit: iso.IsotonicFit | None, cal: Calibration | None,
                          prediction: str = "prediction") -> DataFrame:
    """CAB-3: pred -/+ k iso(pred) (no clamping; NULL bounds without calibration)."""
    if fit is None or cal is None:
        return scored.withColumns({"lower": F.lit(None).cast("double"), "upper": F.lit(None).cast("double")})
    half = F.lit(cal.k) * F.col("_w")
    return (scored.withColumn("_w", fit.predict(F.col(prediction)))
            .withColumns({"lower": F.col(prediction) - half, "upper": F.col(prediction) + half}).drop("_w"))


# --- SNK-7 --------------------------------------------------------------------------

def save_artifacts(path: str, model: PipelineModel, prep: Preprocessor, meta: dict, fit: iso.IsotonicFit | None = None,
                   cal: Calibration | None = None) -> str:
    """Versioned model directory: Spark ML model, preprocessing parameters, metadata, and the
    calibration (isotonic knots and their scale) when there is one."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(os.path.join(path, "model"))
    s = SparkSession.getActiveSession()
    if fit is not None:
        fit.save(s, os.path.join(path, "calibration"))
    s.createDataFrame([(prep.to_json(), json.dumps(meta), json.dumps(asdict(cal)) if cal else None)],
                      "preprocessor string, meta string, calibration string") \
        .coalesce(1).write.mode("overwrite").json(os.path.join(path, "params"))
    return path


def load_calibration(path: str) -> tuple[iso.IsotonicFit | None, Calibration | None]:
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    row = s.read.schema("calibration string").json(os.path.join(path, "params")).first()
    if row["calibration"] is None:
        return None, None
    return iso.IsotonicFit.load(s, os.path.join(path, "calibration")), Calibration(**json.loads(row["calibration"]))


def load_artifacts(path: str):
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    model = PipelineModel.load(os.path.join(path, "model"))
    row = s.read.json(os.path.join(path, "params")).first()
    return model, Preprocessor.from_json(row["preprocessor"]), json.loads(row["meta"])
