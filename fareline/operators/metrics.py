"""Error metrics, business cost, leakage and drift as Spark aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import OVER_PRICE_COST, PSI_HIGH, PSI_MODERATE, UNDER_PRICE_COST
from ..functions.stats import round_half_even_exact, safe_corr
from . import quantiles as qt
from .prep import NUMERIC, number

EPS_MAPE = 2.220446049250313e-16  # float64 machine epsilon, the floor of |y| in MAPE


def regression_metrics(df: DataFrame, y: str = "actual_fare", p: str = "predicted_fare", *,
                       n_features: int | None = None, tolerance: float = 0.15, by=()) -> DataFrame:
    """MET-1..4: rmse, mae, mape, r2 (and adjusted r2), within-tolerance accuracy.

    One pass: SSE, SAE, SST via var_pop * n, all partial-aggregated.
    R2 = 1 - SSE/SST; SST = 0 gives 1 when SSE = 0 else 0.
    """
    e = F.col(p) - F.col(y)
    n = F.count(F.lit(1))
    g = df.groupBy(*by).agg(
        n.alias("n"),
        F.sum(e * e).alias("_sse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(F.abs(e) / F.greatest(F.abs(F.col(y)), F.lit(EPS_MAPE))).alias("mape"),
        (F.var_pop(y) * n).alias("_sst"),
        F.avg((F.abs(e) / F.greatest(F.col(y), F.lit(1e-6)) <= tolerance).cast("double")).alias("within_tol"),
    )
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, 1.0).otherwise(0.0))
          .otherwise(1 - F.col("_sse") / F.col("_sst")))
    out = g.select(*by, "n", F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"), "mae", "mape", r2.alias("r2"),
                   "within_tol")
    if n_features is not None:
        k = n_features
        adj = F.when(F.col("n") - k - 1 <= 0, F.col("r2")).otherwise(
            1 - (1 - F.col("r2")) * (F.col("n") - 1) / (F.col("n") - k - 1))
        out = out.withColumn("adjusted_r2", adj)
    return out


def cost_evaluation(df: DataFrame, y: str = "actual_fare", p: str = "predicted_fare", *,
                    under_cost: float = UNDER_PRICE_COST, over_cost: float = OVER_PRICE_COST) -> DataFrame:
    """MET-5: under / over pricing counts and losses; Python-style half-even rounding."""
    e = F.col(p) - F.col(y)
    g = df.agg(F.count(F.lit(1)).alias("_n"),
               F.count_if(e < 0).alias("under_priced_trips"), F.count_if(e > 0).alias("over_priced_trips"),
               (F.coalesce(F.sum(F.when(e < 0, F.abs(e))), F.lit(0.0)) * under_cost).alias("_under"),
               (F.coalesce(F.sum(F.when(e > 0, F.abs(e))), F.lit(0.0)) * over_cost).alias("_over"))
    total = F.col("_under") + F.col("_over")
    return g.select("under_priced_trips", "over_priced_trips",
                    round_half_even_exact("_under", 2).alias("estimated_revenue_loss"),
                    round_half_even_exact("_over", 2).alias("estimated_trust_cost"),
                    round_half_even_exact(total, 2).alias("total_estimated_cost"),
                    round_half_even_exact(total / F.greatest(F.col("_n"), F.lit(1)), 4).alias("avg_cost_per_trip"))


_CASTABLE = ("double", "float", "int", "bigint", "smallint", "tinyint", "string", "boolean")


def leakage_report(df: DataFrame, target: str, columns, threshold: float = 0.98) -> DataFrame:
    """LKG-1/LKG-2: per column exact match (target cast to the column type,
    null-safe) and |Pearson r| after median-filling nulls; constant columns
    are skipped (r NULL), and so are columns of a type that the target has no
    cast to (timestamps, arrays: no match, no r). NaN counts as null; a target that
    does not fit the column's type is no match. One aggregate for all columns (+ medians only
    for columns that actually hold nulls)."""
    types = dict(df.dtypes)
    columns = [c for c in columns if c != target]
    numeric = [c for c in columns if types[c] in NUMERIC]
    used = [*numeric, target]
    nulls = df.agg(*[F.count_if(number(df, c).isNull()).alias(c) for c in used]).first().asDict()
    need = [c for c in used if nulls[c] > 0]
    qv = qt.quantile_values(df, need, [0.5]) if need else {}
    med = {c: qv.get(((), c, 0.5)) for c in need}

    def filled(c):
        x = number(df, c).cast("double")
        return F.coalesce(x, F.lit(med[c])) if med.get(c) is not None else x

    aggs = []
    for c in columns:
        if types[c] in _CASTABLE:
            x = number(df, c) if c in numeric else F.col(c)
            aggs.append(F.bool_and(x.eqNullSafe(number(df, target).try_cast(types[c]))).alias(f"{c}__eq"))
        else:
            aggs.append(F.lit(False).alias(f"{c}__eq"))
        r = safe_corr(filled(c), filled(target)) if c in numeric else F.lit(None).cast("double")
        aggs.append(r.alias(f"{c}__r"))
    wide = df.agg(F.count(F.lit(1)), *aggs)
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__eq").alias("exact_match"), F.abs(F.col(f"{c}__r")).alias("abs_corr"))
        for c in columns])))
    flag = F.col("exact_match") | F.coalesce(F.col("abs_corr") >= threshold, F.lit(False))
    return long.withColumn("leak_flag", flag)


# --- drift -----------------------------------------------------------------

PSI_PROBS = tuple(i / 10 for i in range(11))


def _long_sides(df: DataFrame, side_col: str, columns) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])
    out = df.select(F.col(side_col).alias("side"), F.inline(entries))
    return out.where(F.col("v").isNotNull() & ~F.isnan("v"))


def _bin(x: Column, edges) -> Column:
    """1-based bin of ``x`` between sorted edges, clipped to the ends; null for a null or NaN value."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    n = F.size(F.filter(F.array(*[F.lit(float(v)) for v in edges]), lambda q: q <= x))
    return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.lit(1), F.least(n, F.lit(len(edges) - 1))))


def psi_edges(long: DataFrame, columns, buckets: int = 10) -> dict:
    """Quantile edges of the expected side (linear interpolation), unique and sorted.

    ``long`` is (feature, v) of the expected side."""
    probs = [i / buckets for i in range(buckets + 1)]
    qv = qt.quantile_values(long, columns, probs, is_long=True)
    out = {}
    for c in columns:
        vals = [qv.get(((), c, p)) for p in probs]
        out[c] = sorted({x for x in vals if x is not None})
    return out


def psi(df: DataFrame, side_col: str, columns, *, expected: str = "expected", buckets: int = 10,
        edges: dict | None = None) -> DataFrame:
    """DRF-1/DRF-2: PSI per column between the ``expected`` side and the rest.

    Only the columns in question are written (wide) to the shared checkpoint folder, once,
    and read for the edge rounds and the final binning. Edges come from the
    expected side; bin = number of edges <= x, clipped to the first / last
    bin (the same as widening the end edges to cover both sides, with the
    last bin closed). Shares are count / (n + 1e-9), a zero share becomes
    1e-6. Fewer than 2 distinct edges -> PSI 0. Output (feature, drift_score).
    """
    spark = df.sparkSession
    columns = list(columns)
    side = F.when(F.col(side_col) == expected, "expected").otherwise("actual")
    with qt.kept(df.select(side.alias("_side"), *columns)) as wide:
        if not edges:
            edges = psi_edges(_long_sides(wide.where(F.col("_side") == "expected"), "_side", columns).select("feature", "v"),
                              columns, buckets)
        entries = F.array(*[F.struct(F.lit(c).alias("feature"), _bin(F.col(c).cast("double"), edges.get(c, [])).alias("bin"))
                            for c in columns])
        # one aggregate: per (feature, side, bin) counts
        binned = (wide.select(F.col("_side").alias("side"), F.inline(entries)).where(F.col("bin").isNotNull())
                  .groupBy("feature", "side", "bin").agg(F.count(F.lit(1)).alias("c")))
        rows = binned.collect()  # O(#features x #bins x 2) rows
    import math
    from collections import defaultdict

    cnt = defaultdict(int)
    tot = defaultdict(int)
    for r in rows:
        cnt[(r["feature"], r["side"], r["bin"])] = r["c"]
        tot[(r["feature"], r["side"])] += r["c"]
    out = []
    for c in columns:
        e = edges.get(c, [])
        if len(e) < 2:
            out.append((c, 0.0))
            continue
        score = 0.0
        for bn in range(1, len(e)):
            ex = cnt[(c, "expected", bn)] / (tot[(c, "expected")] + 1e-9)
            ac = cnt[(c, "actual", bn)] / (tot[(c, "actual")] + 1e-9)
            ex = ex if ex != 0 else 1e-6
            ac = ac if ac != 0 else 1e-6
            score += (ex - ac) * math.log(ex / ac)
        out.append((c, score))
    return spark.createDataFrame(out, "feature string, drift_score double")


def psi_status(score: Column | str = "drift_score", moderate: float = PSI_MODERATE,
               high: float = PSI_HIGH) -> Column:
    """DRF-3: CRITICAL >= 0.20, MODERATE >= 0.10, else OK."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= high, "CRITICAL").when(s >= moderate, "MODERATE").otherwise("OK")


def mean_shift(ref: DataFrame, new: DataFrame, columns, top_n: int = 10) -> DataFrame:
    """DRF-4: |mean_ref - mean_new| / std_ref (sample std, 0 -> 1), top n."""
    columns = list(columns)

    def stats(df, tag):
        return df.agg(*[F.avg(c).alias(f"{c}__m") for c in columns],
                      *[F.stddev_samp(c).alias(f"{c}__s") for c in columns]).select(F.inline(F.array(*[
                          F.struct(F.lit(c).alias("feature"), F.col(f"{c}__m").alias(f"mean_{tag}"),
                                   F.col(f"{c}__s").alias(f"std_{tag}")) for c in columns])))

    j = stats(ref, "ref").join(stats(new, "new"), "feature")
    sd = F.when(F.col("std_ref") == 0, F.lit(1.0)).otherwise(F.col("std_ref"))
    out = j.select("feature", (F.abs(F.col("mean_ref") - F.col("mean_new")) / sd).alias("shift"))
    return out.orderBy(F.desc("shift"), "feature").limit(top_n)
