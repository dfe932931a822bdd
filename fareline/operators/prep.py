"""Feature roles, preprocessing fits and splits (FT-1, PP-*, SEL-*, SPL-*).

Every *fit* is one or a few aggregates returning a small parameter table
(O(#features) or O(#features x #bins) rows); every *transform* is a Column
expression, so fitted preprocessing runs inside codegen on batch and
streaming frames alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CLIP_FOLD, NEVER_POWER_TRANSFORM, ORDINAL_THRESHOLD, ROLE_EXCLUDE, SKEW_THRESHOLD
from ..functions.stats import hash_unit, sample_skewness
from . import quantiles as qt

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


# --- FT-1 ------------------------------------------------------------------

def detect_roles(df: DataFrame, threshold: int = ORDINAL_THRESHOLD, exclude=ROLE_EXCLUDE,
                 exact_below: int | None = None) -> DataFrame:
    """Role of every column: (column, n_unique, role).

    Non-numeric / boolean -> ordinal; numeric with 2 distinct values ->
    binary, 3..threshold -> ordinal, anything else (also 1) -> continuous.
    NULL counts as one more value. Distinct values are counted exactly, as (column, value) groups that map-side
    combine and spread over all tasks. With ``exact_below`` a HyperLogLog pass goes first and only columns whose
    estimate is at most that are counted; the others have no ``n_unique`` and are continuous. A bound below twice
    the threshold and 64 more could miss an ordinal column in the sketch's error and is raised to that.
    """
    types = dict(df.dtypes)
    cols = [c for c in df.columns if c not in exclude]
    nulls = [F.max(F.col(c).isNull().cast("int")).alias(f"{c}__n") for c in cols]
    if exact_below is None:
        est, small = df.agg(*nulls).first(), cols
    else:
        est = df.agg(*[F.approx_count_distinct(c).alias(f"{c}__a") for c in cols], *nulls).first()
        small = [c for c in cols if est[f"{c}__a"] <= max(exact_below, 2 * threshold + 64)]
    exact = {}
    if small:
        entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in small])
        ex = (df.select(F.inline(entries)).where(F.col("value").isNotNull())
              .groupBy("column", "value").count().groupBy("column").count().collect())
        exact = {r["column"]: r["count"] for r in ex}
    rows = []
    for c in cols:
        has_null = int(est[f"{c}__n"] or 0)
        n = (exact.get(c, 0) if c in small else int(est[f"{c}__a"])) + has_null     # an estimate only where it is large
        t = types[c]
        if t not in NUMERIC:
            role = "ordinal"
        elif n == 2:
            role = "binary"
        elif 3 <= n <= threshold:
            role = "ordinal"
        else:
            role = "continuous"
        rows.append((c, n if c in small else None, role))
    return df.sparkSession.createDataFrame(rows, "column string, n_unique bigint, role string")


# --- SPL-* -------------------------------------------------------------------

def hash_bucket(key: str = "event_id", seed: str = "42", buckets: int = 100) -> Column:
    return hash_unit(key, seed=seed) % buckets


def split_label(key: str = "event_id", seed: str = "42", train: int = 64, cal: int = 80) -> Column:
    """SPL-1: 64 / 16 / 20 train / calibration / test from a stable hash
    (independent of partitioning, identical in SQL engines)."""
    b = hash_bucket(key, seed)
    return F.when(b < train, "train").when(b < cal, "calibration").otherwise("test")


def kfold(key: str = "event_id", k: int = 5, seed: str = "42") -> Column:
    """SPL-3: fold id 0..k-1 (repeat with another seed for repeated k-fold)."""
    return (hash_unit(key, seed=seed) % k).cast("int")


def time_cutoffs(df: DataFrame, ts: str, fractions) -> dict:
    """SPL-2/SPL-4: ``sorted(ts)[int(f * n)]`` for each fraction, exact and
    distributed (timestamps as epoch microseconds)."""
    micros = df.select(F.unix_micros(F.col(ts).cast("timestamp")).cast("double").alias("_us"))
    vals = qt.order_statistic_values(micros, "_us", list(fractions))
    return {f: int(vals[((), f)]) for f in fractions}


# --- PP-1 clip -------------------------------------------------------------

def fit_clip(df: DataFrame, columns, fold: float = CLIP_FOLD, *, exact: bool = True) -> dict:
    """{column: (lo, hi)}: [Q1 - f IQR, Q3 + f IQR]; IQR == 0 -> (None, None) = no clipping."""
    q = qt.quantile_values(df, columns, [0.25, 0.75], exact=exact)
    out = {}
    for c in columns:
        q1, q3 = q.get(((), c, 0.25)), q.get(((), c, 0.75))
        if q1 is None or q3 is None or q3 - q1 == 0:
            out[c] = (None, None)
        else:
            out[c] = (q1 - fold * (q3 - q1), q3 + fold * (q3 - q1))
    return out


def clip_expr(c: str, bounds) -> Column:
    lo, hi = bounds
    if lo is None:
        return F.col(c)
    x = F.col(c)
    return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.least(x, F.lit(hi)), F.lit(lo))).otherwise(x)


def apply_clip(df: DataFrame, bounds: dict) -> DataFrame:
    return df.withColumns({c: clip_expr(c, b) for c, b in bounds.items()})


def number(df: DataFrame, c: str) -> Column:
    """The column, NaN as null."""
    return F.when(~F.isnan(c), F.col(c)) if dict(df.dtypes)[c] in ("double", "float") else F.col(c)


# --- PP-2 skew -------------------------------------------------------------

def skew_split(df: DataFrame, columns, threshold: float = SKEW_THRESHOLD, never=NEVER_POWER_TRANSFORM):
    """(skewed, other) column lists by bias-corrected |skew| > threshold; one aggregate."""
    row = df.agg(*[sample_skewness(number(df, c)).alias(c) for c in columns]).first()
    skewed = [c for c in columns if c not in never and row[c] is not None and abs(row[c]) > threshold]
    return skewed, [c for c in columns if c not in skewed], {c: row[c] for c in columns}


# --- PP-3 Yeo-Johnson --------------------------------------------------------

def yeo_johnson(x, lam: float) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    pos = F.log1p(c) if abs(lam) < 1e-12 else (F.pow(c + 1, F.lit(lam)) - 1) / lam
    neg = -F.log1p(-c) if abs(lam - 2) < 1e-12 else -(F.pow(-c + 1, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(c >= 0, pos).otherwise(neg)


def yeo_johnson_sql(x: str, lam: float) -> str:
    """SQL text of the Yeo-Johnson transform of expression ``x``."""
    lam = float(lam)
    pos = f"log1p({x})" if abs(lam) < 1e-12 else f"(pow({x} + 1, {lam!r}D) - 1) / {lam!r}D"
    neg = f"-log1p(-{x})" if abs(lam - 2) < 1e-12 else f"-(pow(-{x} + 1, {2 - lam!r}D) - 1) / {2 - lam!r}D"
    return f"CASE WHEN {x} >= 0 THEN {pos} ELSE {neg} END"


def _yj_aggs(grids: dict) -> list[str]:
    exprs = []
    for c, lams in grids.items():
        exprs.append(f"count(`{c}`) AS `{c}__n`")
        exprs.append(f"sum(signum(`{c}`) * log1p(abs(`{c}`))) AS `{c}__s`")
        exprs += [f"var_pop({yeo_johnson_sql(f'`{c}`', lam)}) AS `{c}__v{i}`" for i, lam in enumerate(lams)]
    return exprs


def _yj_log_aggs(grids: dict) -> list[str]:
    """``_yj_aggs`` where a column ``<name>__l`` holds log1p(|x|): a power is then one exp, as pow(1 + |x|, a) = exp(a log1p(|x|))."""
    def moved(c: str, lam: float) -> str:
        side = lambda a: f"`{c}__l`" if abs(a) < 1e-12 else f"(exp({a!r}D * `{c}__l`) - 1) / {a!r}D"
        return f"CASE WHEN `{c}` >= 0 THEN {side(lam)} ELSE -({side(2 - lam)}) END"

    exprs = []
    for c, lams in grids.items():
        exprs += [f"count(`{c}`) AS `{c}__n`", f"sum(signum(`{c}`) * `{c}__l`) AS `{c}__s`"]
        exprs += [f"var_pop({moved(c, float(lam))}) AS `{c}__v{i}`" for i, lam in enumerate(lams)]
    return exprs


def yj_moments(df: DataFrame, grids: dict) -> dict:
    """{column: (n, sum(sign(x) log1p(|x|)), [var_pop(yj(x)) of each lambda])} of columns without NaN, in one pass; no entry for a column
    without values. A task works out its sums with numpy, and one group per column and lambda merges them: written as an aggregate
    for each of them, the plan of a grid and its code are hundreds of MB on the driver. A power is one exp, as
    pow(1 + |x|, a) = exp(a log1p(|x|))."""
    cols = list(grids)

    def side(a: float, log: np.ndarray) -> np.ndarray:
        return log if abs(a) < 1e-12 else (np.exp(a * log) - 1) / a

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for j, c in enumerate(cols):
                x = batch.column(j).drop_null().to_numpy()
                if not len(x):
                    continue
                with np.errstate(all="ignore"):
                    log, up = np.log1p(np.abs(x)), x >= 0
                    over, under = log[up], log[~up]
                    s = over.sum() - under.sum()
                    for i, lam in enumerate(grids[c]):
                        y = np.concatenate([side(lam, over), -side(2 - lam, under)])
                        mean = y.mean()
                        q = np.square(y - mean).sum()
                        n0, m0, q0, s0 = held.get((j, i), (0, mean, 0.0, 0.0))
                        n, d = n0 + len(x), mean - m0
                        held[j, i] = (n, m0 + d * len(x) / n, q0 + q + d * d * n0 * len(x) / n, s0 + s)
        if held:
            keys, values = zip(*held.items())
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32()) for v in zip(*keys)] + [pa.array(v, pa.float64()) for v in zip(*values)],
                                             ["j", "i", "n", "m", "q", "s"])

    parts = df.select(*[F.col(c).cast("double") for c in cols]).mapInArrow(sums, "j int, i int, n double, m double, q double, s double")
    w = Window.partitionBy("j", "i")
    apart = F.col("m") - F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w)
    merged = parts.withColumn("q", F.col("q") + F.col("n") * apart * apart).groupBy("j", "i") \
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), (F.sum("q") / F.sum("n")).alias("v")).orderBy("j", "i").collect()  # one per column and lambda
    out: dict = {}
    for r in merged:
        out.setdefault(cols[r["j"]], (r["n"], r["s"], []))[2].append(r["v"])
    return out


def yj_loglik_grid(df: DataFrame, columns, lambdas) -> DataFrame:
    """ll(lambda) = -n/2 ln(var_pop(yj(x))) + (lambda - 1) sum(sign(x) log1p(|x|)),
    for every (column, lambda) in ONE aggregate. Output (feature, lambda, ll)."""
    wide = df.selectExpr(*_yj_aggs({c: list(lambdas) for c in columns}))
    rows = ", ".join(f"'{c}', {float(lam)!r}D, -`{c}__n` / 2 * ln(`{c}__v{i}`) + ({float(lam)!r}D - 1) * `{c}__s`"
                     for c in columns for i, lam in enumerate(lambdas))
    return wide.selectExpr(f"stack({len(columns) * len(lambdas)}, {rows}) AS (feature, lambda, ll)")


def fit_yeo_johnson(df: DataFrame, columns, lo: float = -2.0, hi: float = 2.0, points: int = 21,
                    rounds: int = 4) -> dict:
    """{column: lambda} by maximum likelihood: a grid search (one pass
    for all columns) that first widens a column's range until its maximum lies inside and
    then zooms ``rounds`` times. std < 1e-8 or a non-finite optimum -> 1.0 (identity)."""
    sd = df.agg(*[F.stddev_pop(number(df, c)).alias(c) for c in columns]).first()
    todo = [c for c in columns if sd[c] is not None and sd[c] >= 1e-8]
    df = df.select([number(df, c).alias(c) for c in columns])
    out = {c: 1.0 for c in columns}
    ranges, left = {c: (lo, hi) for c in todo}, {c: rounds for c in todo}
    while todo:
        grids = {c: [ranges[c][0] + (ranges[c][1] - ranges[c][0]) * i / (points - 1) for i in range(points)] for c in todo}
        found = yj_moments(df, grids)
        for c in list(todo):
            best = None
            n, s, variances = found.get(c, (0, 0.0, []))
            for i, (lam, v) in enumerate(zip(grids[c], variances)):
                if 0 < v < math.inf:
                    ll = -n / 2 * math.log(v) + (lam - 1) * s
                    if math.isfinite(ll) and (best is None or ll > best[0]):
                        best = (ll, lam, i)
            if best is None:
                todo.remove(c)
                continue
            (a, b), lam = ranges[c], best[1]
            out[c] = lam
            if best[2] in (0, points - 1) and left[c] == rounds:
                ranges[c] = (lam - (b - a), lam + (b - a))      # the maximum may lie outside
                continue
            left[c] -= 1
            ranges[c] = (lam - (b - a) / (points - 1), lam + (b - a) / (points - 1))
            if left[c] == 0:
                todo.remove(c)
    return out


# --- PP-4 standardise --------------------------------------------------------

def fit_standard(df: DataFrame, columns) -> dict:
    """{column: (mean, std_pop or 1 when 0)} - population std, as the reference scaler."""
    x = {c: number(df, c) for c in columns}
    r = df.agg(*[F.avg(x[c]).alias(f"{c}__m") for c in columns], *[F.stddev_pop(x[c]).alias(f"{c}__s") for c in columns]).first()
    return {c: (r[f"{c}__m"], r[f"{c}__s"] if r[f"{c}__s"] else 1.0) for c in columns}


def standard_expr(c: str, params) -> Column:
    m, s = params
    return (F.col(c) - F.lit(m)) / F.lit(s)


# --- PP-5 ordinal ------------------------------------------------------------

def fit_ordinal(df: DataFrame, columns) -> DataFrame:
    """Dictionary (feature, value, code): sorted distinct values -> 0..m-1.

    Values are compared as doubles for numeric columns (9 < 10 < 11, not the
    string order of StringIndexer). The dictionary has one row per distinct
    value of an ordinal column (small by the role rule)."""
    types = dict(df.dtypes)
    parts = []
    for c in columns:
        num = types[c] in NUMERIC
        v = F.col(c).cast("double") if num else F.lit(None).cast("double")
        s = F.lit(None).cast("string") if num else F.col(c).cast("string")
        parts.append(df.select(F.lit(c).alias("feature"), v.alias("num_value"), s.alias("str_value"))
                     .where(F.col(c).isNotNull()).distinct())
    d = parts[0]
    for p in parts[1:]:
        d = d.unionByName(p)
    w = Window.partitionBy("feature").orderBy("num_value", "str_value")
    return d.withColumn("code", (F.dense_rank().over(w) - 1).cast("int"))


def apply_ordinal(df: DataFrame, dictionary: DataFrame, columns, suffix: str = "_code") -> DataFrame:
    """Left join to the dictionary (a broadcast where Spark finds it small enough); unknown values -> -1."""
    types = dict(df.dtypes)
    out = df
    for c in columns:
        num = types[c] in NUMERIC
        d = dictionary.where(F.col("feature") == c)
        key = "num_value" if num else "str_value"
        d = d.select(F.col(key).alias(f"_{c}_k"), F.col("code").alias(f"{c}{suffix}"))
        kcol = F.col(c).cast("double") if num else F.col(c).cast("string")
        out = out.join(d, kcol == F.col(f"_{c}_k"), "left").drop(f"_{c}_k")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1)))
    return out


# --- SEL-1 binned mutual information ------------------------------------------

def binned_mutual_information(df: DataFrame, columns, target: str, bins: int = 20) -> DataFrame:
    """Mutual information of every feature with the target on quantile bins.

    Edges: exact quantiles at 1/bins .. (bins-1)/bins (unique); bin = number
    of edges <= x. One long-form grouping (feature, bx, by) -> counts; MI =
    sum p ln(p / (px py)) over the small count table. Output (feature, mi)."""
    spark = df.sparkSession
    probs = [i / bins for i in range(1, bins)]
    cols = list(columns) + [target]
    qv = qt.quantile_values(df, cols, probs)
    edges = {c: sorted({qv[((), c, p)] for p in probs if qv[((), c, p)] is not None}) for c in cols}
    ty = edges[target]

    def b(x, e):
        return F.size(F.filter(F.array(*[F.lit(float(v)) for v in e]), lambda q: q <= x)) if e else F.lit(0)

    entries = F.array(*[F.struct(F.lit(c).alias("feature"), b(F.col(c).cast("double"), edges[c]).alias("bx"))
                        for c in columns])
    base = df.where(F.col(target).isNotNull()).select(b(F.col(target).cast("double"), ty).alias("by"), F.inline(entries))
    counts = base.groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).alias("c"))
    wf = Window.partitionBy("feature")
    wx = Window.partitionBy("feature", "bx")
    wy = Window.partitionBy("feature", "by")
    n = F.sum("c").over(wf)
    pxy = F.col("c") / n
    px = F.sum("c").over(wx) / n
    py = F.sum("c").over(wy) / n
    terms = counts.select("feature", (pxy * F.log(pxy / (px * py))).alias("t"))
    return terms.groupBy("feature").agg(F.sum("t").alias("mi"))


def sample_n(df: DataFrame, n: int, key: str = "event_id", seed: str = "42") -> DataFrame:
    """SRC-5: reproducible sample of exactly min(n, rows) rows without replacement:
    the n smallest md5-of-key hashes (ties broken by the key, then the row).

    The n-th smallest hash is an exact distributed order statistic; a filter
    keeps the rows below it and only rows that tie with it are ordered, so no
    task ever holds n rows."""
    h = hash_unit(key, seed=seed)
    total = df.count()
    if total <= n:
        return df
    hv = df.select(h.cast("double").alias("_h"))
    t = qt.order_statistic_values(hv, "_h", [(n - 1 + 0.5) / total])[((), (n - 1 + 0.5) / total)]
    below = df.where(h < F.lit(int(t)))
    need = n - below.count()
    tied = df.where(h == F.lit(int(t))).orderBy(key, *[c for c in df.columns if c != key]).limit(max(need, 0))
    return below.unionByName(tied)


def sample_with_replacement(df: DataFrame, n: int, key: str = "event_id", seed: str = "7") -> DataFrame:
    """SRC-6: about ``n`` rows with replacement. Each row is taken k times, k from the
    Poisson distribution with mean n / rows at the row's hash (column ``copy``
    numbers them), however small the table."""
    lam = n / max(df.count(), 1)
    cdf, term, total, k = [], math.exp(-lam), 0.0, 0
    while total < 1 - 2.0 ** -34 and (k < lam or term > 0):
        total += term
        cdf.append(total)
        k += 1
        term *= lam / k
    u = hash_unit(key, seed=seed) / F.lit(4294967296.0)
    times = F.size(F.filter(F.array(*map(F.lit, cdf)), lambda c: c <= u))
    return df.withColumn("_times", times).where("_times > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")
