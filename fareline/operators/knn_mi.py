"""SEL-1: nearest-neighbour mutual information of many features with one target, over all rows.

The estimator of Kraskov et al. (2004, first form): r is a row's Chebyshev distance to its k-th neighbour in the (feature, target)
plane, n_x and n_y the rows nearer than r on each axis (the row itself counts), and

    MI = psi(n) + psi(k) - mean(psi(n_x) + psi(n_y)),  not below 0

Equal points are one point with a multiplicity, so ties and hot values cost nothing; a row with k copies has r = 0 and counts
its equals. The distributed steps, for all features at once:

1. points sorted by (feature, x, y) fall into strips of about ``strip`` points; the k nearest inside the own strip bound r;
2. a point asks every other strip whose bounding box comes nearer than that bound (strips follow x, so a binary search
   finds them); strips answer with at most k distances, and the k-th of all is exact;
3. n_x and n_y are differences of ranks: thresholds and values are sorted together into ranges, ranks are running sums
   inside a range plus what the ranges before hold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .quantiles import long_form

STRIP = 20_000              # points of a strip
NEIGHBOURS = 3


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nearest(qx, qy, px, py, pw, k: int, bound=None, own: bool = False, scale: tuple[float, float] = (1.0, 1.0)) -> np.ndarray:
    """[query, k] smallest Chebyshev distances, in units of ``scale`` on the two axes, to the weighted points, ascending, inf where
    there are fewer or none below ``bound``. ``own``: the queries are the points, and one copy of each is the query itself."""
    sx, sy = scale
    best = np.full((len(qx), k), np.inf)
    if not len(px) or not len(qx):
        return best
    # walk outwards along the axis with fewer equal values
    if len(np.unique(px)) > len(np.unique(py)):
        qx, qy, px, py, sx, sy = qy, qx, py, px, sy, sx
    order = np.argsort(py, kind="stable")
    px, py, pw = px[order], py[order], pw[order]
    limit = np.full(len(qx), np.inf) if bound is None else np.asarray(bound, float).copy()
    start = np.searchsorted(py, qy, side="left")
    if own:
        start = np.empty(len(order), np.int64)
        start[order] = np.arange(len(order))
        copies = np.minimum(pw[start] - 1, k).astype(np.int64)
        best[np.arange(k)[None, :] < copies[:, None]] = 0.0
        limit = np.minimum(limit, best[:, -1])

    def take(rows, at):
        d = np.maximum(np.abs(px[at] - qx[rows]) / sx, np.abs(py[at] - qy[rows]) / sy)
        near = d < limit[rows]
        rows, at, d = rows[near], at[near], d[near]
        if len(rows):
            times = np.minimum(pw[at], k).astype(np.int64)
            more = np.where(np.arange(k)[None, :] < times[:, None], d[:, None], np.inf)
            best[rows] = np.sort(np.concatenate([best[rows], more], axis=1), axis=1)[:, :k]
            limit[rows] = np.minimum(limit[rows], best[rows, -1])

    for step in (1, -1):
        at = start + (1 if own else 0) if step > 0 else start - 1
        rows = np.arange(len(qx))
        while len(rows):
            inside = (at >= 0) & (at < len(py))
            rows, at = rows[inside], at[inside]
            go = np.abs(py[at] - qy[rows]) / sy < limit[rows]
            rows, at = rows[go], at[go]
            take(rows, at)
            at = at + step
    return best


def thresholds(x: np.ndarray, r: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest number whose distance from x, in units of ``scale``, is below r (0 for r = 0): by
    bisection on the computed distance, so that a value is inside exactly if its own computed distance is."""
    rad = np.nextafter(r, 0.0)
    far = rad * scale
    out = []
    for sign in (-1.0, 1.0):
        inside = x + sign * far * (1 - 1e-9)
        inside = np.where(np.abs(inside - x) / scale <= rad, inside, x)
        outside = x + sign * (far * (1 + 1e-9) + 2 * np.spacing(np.abs(x) + far))
        for _ in range(64):
            middle = inside + (outside - inside) / 2
            near = np.abs(middle - x) / scale <= rad
            inside, outside = np.where(near, middle, inside), np.where(near, outside, middle)
        out.append(np.where(rad > 0, inside, x))
    return out[0], out[1]


def digamma(n: np.ndarray) -> np.ndarray:
    """psi of positive numbers: the recurrence up to 10, then the asymptotic series."""
    n, out = np.asarray(n, float).copy(), 0.0
    out = np.zeros_like(n)
    for _ in range(10):
        low = n < 10
        out -= np.where(low, 1 / np.where(low, n, 1.0), 0.0)
        n = np.where(low, n + 1, n)
    s = 1 / (n * n)
    return out + np.log(n) - 0.5 / n - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s / 132))))


def _psi(n: Column) -> Column:
    @F.arrow_udf("double")
    def run(v: pa.Array) -> pa.Array:
        return pa.array(digamma(v.to_numpy(zero_copy_only=False)))

    return run(n.cast("double"))


def _points(df: DataFrame, columns, target: str) -> DataFrame:
    """f, x, y, w, sx, sy: distinct points of every feature (its number in ``columns``) with the target, and the two standard
    deviations (1 for a constant). Distances are taken on the values as they are and scaled then, so equal steps stay equal."""
    rows = df.select(*columns, F.col(target).cast("double").alias("_y")).where("_y IS NOT NULL AND NOT isnan(_y)")
    number = F.create_map(*[F.lit(v) for i, c in enumerate(columns) for v in (c, i)])
    long = long_form(rows, list(columns), ["_y"]).select(number[F.col("feature")].alias("f"), "v", "_y")
    scale = long.groupBy("f").agg(F.stddev_pop("v").alias("sx"), F.stddev_pop("_y").alias("sy"))       # one row per feature
    one = lambda c: F.when(F.col(c) > 0, F.col(c)).otherwise(F.lit(1.0))
    points = long.groupBy("f", "v", "_y").agg(F.count(F.lit(1)).alias("w"))
    return points.join(F.broadcast(scale), "f").select("f", F.col("v").alias("x"), F.col("_y").alias("y"), "w",
                                                       one("sx").alias("sx"), one("sy").alias("sy"))


def _near_strips(box: np.ndarray, own: int, x: np.ndarray, y: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, strip) of the other strips whose box comes within dx and dy of a query; ``box`` holds rows of strip, x0, x1, y0, y1
    with x0 and x1 ascending."""
    i, j = np.searchsorted(box[:, 2], x - dx, side="left"), np.searchsorted(box[:, 1], x + dx, side="right")
    many = np.maximum(j - i, 0) * (dx > 0)
    q = np.repeat(np.arange(len(x)), many)
    at = np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many) + i[q]
    near = (box[at, 3] <= y[q] + dy[q]) & (box[at, 4] >= y[q] - dy[q]) & (box[at, 0] != own)
    return q[near], box[at[near], 0].astype(np.int64)


def _radii(points: DataFrame, k: int, strip: int) -> DataFrame:
    """f, x, y, w, sx, sy, r: the exact distance of every point to its k-th neighbour."""
    spark = points.sparkSession
    n = points.count()
    ranged = points.repartitionByRange(max(1, -(-n // strip)), "f", "x", "y").withColumn("strip", F.spark_partition_id())
    ranged = _written(ranged, "mi-strips")
    boxes = ranged.groupBy("f", "strip").agg(*[f(c).alias(f"{c}{s}") for c in "xy" for s, f in (("0", F.min), ("1", F.max))])
    each: dict[int, list] = {}
    for r in boxes.orderBy("f", "strip").collect():       # a row for every STRIP points
        each.setdefault(r["f"], []).append(tuple(r)[1:])
    listed = spark.sparkContext.broadcast({f: np.array(b, float) for f, b in each.items()})
    ds = [f"d{i}" for i in range(k)]

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        (x, y, w), sx, sy = (pdf[c].to_numpy() for c in "xyw"), pdf["sx"].iloc[0], pdf["sy"].iloc[0]
        d = nearest(x, y, x, y, w, k, own=True, scale=(sx, sy))
        far = d[:, -1] * (1 + 1e-9)
        q, other = _near_strips(listed.value[int(pdf["f"].iloc[0])], int(pdf["strip"].iloc[0]), x, y, far * sx, far * sy)
        asks = np.split(other, np.searchsorted(q, np.arange(1, len(x))))
        none: list[int] = []
        return pdf[["f", "x", "y", "w", "sx", "sy"]].assign(**{c: d[:, i] for i, c in enumerate(ds)}, asks=pd.Series([a.tolist() if len(a) else none for a in asks], index=pdf.index, dtype=object))

    distances = ", ".join(f"{c} double" for c in ds)
    found = _written(ranged.groupBy("strip", "f").applyInPandas(local, f"f int, x double, y double, w long, sx double, sy double, {distances}, asks array<int>"), "mi-local")
    asks = found.select("f", "x", "y", F.col(ds[-1]).alias("r"), F.explode("asks").alias("strip"))

    def answer(block: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(q):
            return pd.DataFrame({c: [] for c in ("f", "x", "y", *ds)})
        d = nearest(q["x"].to_numpy(), q["y"].to_numpy(), *(block[c].to_numpy() for c in "xyw"), k, bound=q["r"].to_numpy(),
                    scale=(block["sx"].iloc[0], block["sy"].iloc[0]))
        return q[["f", "x", "y"]].assign(**{c: d[:, i] for i, c in enumerate(ds)})

    answers = (ranged.groupBy("strip", "f").cogroup(asks.groupBy("strip", "f"))
               .applyInPandas(answer, f"f int, x double, y double, {distances}"))
    alone, asked = found.where(F.size("asks") == 0), found.where(F.size("asks") > 0)        # the others are exact already
    every = asked.drop("asks").unionByName(answers, allowMissingColumns=True)
    merged = every.groupBy("f", "x", "y").agg(*[F.max(c).alias(c) for c in ("w", "sx", "sy")], F.flatten(F.collect_list(F.array(*ds))).alias("d"))
    columns = ["f", "x", "y", "w", "sx", "sy"]
    return _written(merged.select(*columns, F.get(F.sort_array("d"), F.lit(k - 1)).alias("r"))
                    .unionByName(alone.select(*columns, F.col(ds[-1]).alias("r"))), "mi-radii")


def _ranks(radii: DataFrame, axis: str) -> DataFrame:
    """f, x, y, w, n: for every point two rows, of which the sum of n is the rows nearer than r on the axis."""
    @F.arrow_udf("struct<low double, high double>")
    def ends(v: pa.Array, r: pa.Array, scale: pa.Array) -> pa.Array:
        low, high = thresholds(*(a.to_numpy(zero_copy_only=False) for a in (v, r, scale)))
        return pa.StructArray.from_arrays([pa.array(low), pa.array(high)], ["low", "high"])

    none = F.lit(None).cast("double")
    values = radii.groupBy("f", F.col(axis).alias("v")).agg(F.sum("w").alias("held")).select("f", "v", F.lit(1).alias("kind"), none.alias("x"), none.alias("y"), F.lit(None).cast("long").alias("w"), "held")
    asked = radii.withColumn("e", ends(F.col(axis), F.col("r"), F.col(f"s{axis}")))
    both = F.array(F.struct(F.col("e.low").alias("v"), F.lit(0).alias("kind")), F.struct(F.col("e.high").alias("v"), F.lit(2).alias("kind")))
    rows = values.unionByName(asked.select("f", "x", "y", "w", F.inline(both)).withColumn("held", F.lit(0).cast("long")))
    order = ["f", "v", "kind", "x", "y"]
    ranged = _written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mi-ranks")
    sums = ranged.groupBy("f", "part").agg(F.sum("held").alias("s"))
    before = sums.withColumn("before", F.sum("s").over(Window.partitionBy("f").orderBy("part")) - F.col("s")).select("f", "part", "before")
    run = F.sum("held").over(Window.partitionBy("part", "f").orderBy("v", "kind", "x", "y").rowsBetween(Window.unboundedPreceding, 0))
    rank = ranged.withColumn("run", run).where("kind <> 1").join(F.broadcast(before), ["f", "part"])      # a row per range and feature
    sign = F.when(F.col("kind") == 2, 1).otherwise(-1)
    return rank.select("f", "x", "y", "w", (sign * (F.col("run") + F.col("before"))).alias("n"))


def knn_mutual_information(df: DataFrame, columns, target: str, *, k: int = NEIGHBOURS, strip: int = STRIP) -> DataFrame:
    """feature, mi: one row per feature with more than ``k`` rows; rows where feature or target is null or NaN do not count for it."""
    columns = list(columns)
    points = _written(_points(df, columns, target), "mi-points")
    totals = points.groupBy("f").agg(F.sum("w").alias("total")).where(F.col("total") > k)
    radii = _radii(points.join(F.broadcast(totals.select("f")), "f", "left_semi"), k, strip)
    none = F.lit(None).cast("long")
    ranks = (_ranks(radii, "x").withColumnsRenamed({"n": "nx"}).withColumn("ny", none)
             .unionByName(_ranks(radii, "y").withColumnsRenamed({"n": "ny"}).withColumn("nx", none)))
    n = ranks.groupBy("f", "x", "y").agg(F.max("w").alias("w"), F.sum("nx").alias("nx"), F.sum("ny").alias("ny"))
    psi = n.select("f", "w", (_psi(F.col("nx")) + _psi(F.col("ny"))).alias("p"))
    mean = psi.groupBy("f").agg((F.sum(F.col("w") * F.col("p")) / F.sum("w")).alias("mean"), F.sum("w").alias("total"))
    mi = _psi(F.col("total")) + F.lit(float(digamma(np.array([k]))[0])) - F.col("mean")
    return mean.select(F.element_at(F.array(*map(F.lit, columns)), F.col("f") + 1).alias("feature"), F.greatest(mi, F.lit(0.0)).alias("mi"))
