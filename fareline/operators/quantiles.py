"""Exact quantiles without sending a column through one task.

Spark's exact ``percentile`` keeps a value -> count map per group, and the
final merge of a global percentile holds every distinct value of the column
in ONE task: fine for a million rows, fatal for 100 TB. This operator finds
the exact order statistics by distributed histogram refinement instead:

  round 0   one aggregate per (group, feature): n, min, max, and a sketch
            (percentile_approx) guess of a narrow bracket around each target
  round i   for each open rank target, a range [lo, hi] known to contain it
            and the count of values below lo; every scan buckets the values
            inside the open ranges into <= B buckets (count, min, max) with a
            partial aggregate; the driver receives O(#targets x B) rows and
            narrows each range to the bucket holding the rank
  finish    a range whose min == max is solved; a range holding at most
            ``collect_limit`` values ships those values (bounded) instead

Each round is a linear scan with map-side combine, so a hot value holding a
third of all rows costs one bucket, not a skewed task. Interpolation follows
the linear rule of numpy / DuckDB ``quantile_cont``:
q(p) = x[floor(h)] + (h - floor(h)) * (x[floor(h)+1] - x[floor(h)]), h = (n-1)p.

``exact=False`` switches to one ``percentile_approx`` pass.
"""

from __future__ import annotations

import math
from collections import defaultdict
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path, scratch_path

HIST_BUDGET = 50_000        # histogram rows shipped to the driver per round
MAX_BUCKETS = 1024
COLLECT_LIMIT = 20_000      # values shipped for one finished range
COLLECT_BUDGET = 400_000    # values shipped per round in total
MAX_GROUPS = 200_000        # (group, feature) pairs whose state the driver holds


@contextmanager
def kept(df: DataFrame):
    """``df`` written once to the shared checkpoint folder and read back, for
    operators that scan it several times; the folder goes afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, "kept")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def long_form(df: DataFrame, value_cols, group_cols=()) -> DataFrame:
    """(group cols..., feature, v) with one row per non-null, non-NaN value."""
    from ..functions.stats import stack_sql

    out = df.selectExpr(*[f"`{g}`" for g in group_cols], stack_sql(value_cols))
    return out.where("v IS NOT NULL AND NOT isnan(v)")


def _gkey(group_cols) -> F.Column:
    if not group_cols:
        return F.lit("")
    return F.to_json(F.struct(*[F.col(c) for c in group_cols]))


def quantile_values(df: DataFrame, value_cols, probs, group_cols=(), *, exact: bool = True,
                    accuracy: int = 100_000, is_long: bool = False) -> dict:
    """{(group tuple, feature, p): value} for every group / feature / prob.

    Nulls and NaN are ignored; without group columns a feature without values yields
    None (a group without values has no entry). The needed columns are written once, wide,
    and unpivoted in each scan. With ``is_long=True`` ``df`` is already
    (group cols..., feature, v) and is read again in every round: it should
    be a projection of written columns.
    """
    value_cols = list(value_cols)
    group_cols = list(group_cols)
    probs = [float(p) for p in probs]
    def keyed(lf):
        return lf.withColumn("_gk", _gkey(group_cols)).select("_gk", *group_cols, "feature", "v")

    if not exact:
        lf = keyed(df if is_long else long_form(df, value_cols, group_cols))
        aggs = [F.percentile_approx("v", F.array(*[F.lit(p) for p in probs]), accuracy).alias("q")]
        rows = lf.groupBy("_gk", *group_cols, "feature").agg(*aggs).collect()
        out = {}
        for r in rows:
            g = tuple(r[c] for c in group_cols)
            for p, q in zip(probs, r["q"]):
                out[(g, r["feature"], p)] = q
    elif is_long:
        out = _exact(keyed(df), group_cols, value_cols, probs)
    else:
        with kept(df.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in value_cols if c not in group_cols])) as wide:
            out = _exact(keyed(long_form(wide, value_cols, group_cols)), group_cols, value_cols, probs)
    if not group_cols:
        for c in value_cols:
            for p in probs:
                out.setdefault(((), c, p), None)
    return out


def _targets_for_probs(probs):
    def fn(n):
        out = []
        for p in probs:
            h = (n - 1) * p
            k0 = int(math.floor(h))
            out.append((p, k0, min(k0 + 1, n - 1), h - k0))
        return out
    return fn


APPROX_ACCURACY = 10_000   # sketch accuracy used to seed the first brackets
BRACKET = 4.0 / APPROX_ACCURACY


def _exact(lf: DataFrame, group_cols, value_cols, probs, targets_fn=None, fractions=None) -> dict:
    """Order statistics by bracket refinement (see the module docstring).

    Round 0 also asks a ``percentile_approx`` sketch for values just below and
    above every target fraction; those brackets are only a guess: the next
    scan counts the rows below the bracket, and a target whose rank is not
    inside falls back to the group's [min, max]. Results never depend on the
    sketch, only the number of rounds does.
    """
    spark = lf.sparkSession
    targets_fn = targets_fn or _targets_for_probs(probs)
    fracs = sorted(set(float(f) for f in (fractions if fractions is not None else probs)))
    probes = sorted({min(1.0, max(0.0, f + d)) for f in fracs for d in (-BRACKET, BRACKET)})
    aggs = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    if probes:
        aggs.append(F.percentile_approx("v", F.array(*[F.lit(p) for p in probes]), APPROX_ACCURACY).alias("qa"))
    stats = lf.groupBy("_gk", *group_cols, "feature").agg(*aggs).limit(MAX_GROUPS + 1).collect()
    if len(stats) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} (group, feature) pairs: use exact=False, which stays distributed, "
                         "or fewer groups at a time")
    # target key: (gk, feature, k); state: [lo, hi, below (None = unknown), value, count bound]
    state: dict = {}
    full: dict = {}
    needs = []   # (group tuple, feature, p, gk, k0, k1, frac)
    for r in stats:
        gk, feat, n = r["_gk"], r["feature"], r["n"]
        g = tuple(r[c] for c in group_cols)
        full[(gk, feat)] = [r["lo"], r["hi"], 0, r["lo"] if r["lo"] == r["hi"] else None, n]
        approx = dict(zip(probes, r["qa"])) if probes else {}
        for p, k0, k1, frac in targets_fn(n):
            needs.append((g, feat, p, gk, k0, k1, frac))
            for k in (k0, k1):
                key = (gk, feat, k)
                if key in state:
                    continue
                start = list(full[(gk, feat)])
                if start[3] is None and n > COLLECT_LIMIT and approx:
                    f = min(fracs, key=lambda x: abs(x - (k + 0.5) / n))
                    lo = approx[min(1.0, max(0.0, f - BRACKET))]
                    hi = approx[min(1.0, max(0.0, f + BRACKET))]
                    if lo is not None and hi is not None and lo <= hi:
                        est = int(min(n, (2 * BRACKET + 2.0 / APPROX_ACCURACY) * n + 2))
                        start = [lo, hi, 0 if lo <= r["lo"] else None, None, est]
                state[key] = start
    while open_keys := [k for k, s in state.items() if s[3] is None]:     # every round narrows every open range
        ranges = defaultdict(list)   # (gk, feat, lo, hi, below, count) -> target keys
        for key in open_keys:
            lo, hi, below, _, cnt = state[key]
            ranges[(key[0], key[1], lo, hi, below, cnt)].append(key)
        budget = COLLECT_BUDGET
        small, big = [], []
        for rk in ranges:
            if rk[5] <= COLLECT_LIMIT and rk[5] <= budget:
                small.append(rk)
                budget -= rk[5]
            else:
                big.append(rk)
        if small:
            below_of, vals = _range_values(spark, lf, small)
            for rid, rk in enumerate(small):
                below = rk[4] if rk[4] is not None else below_of.get(rid, 0)
                v = sorted(vals.get(rid, []))
                total = sum(c for _, c in v)
                for key in ranges[rk]:
                    k = key[2]
                    if not below <= k < below + total:
                        state[key] = list(full[(key[0], key[1])])   # bracket missed: widen
                        continue
                    pos = below
                    for val, c in v:
                        if pos + c > k:
                            state[key][3] = val
                            break
                        pos += c
        if big:
            nb = max(16, min(MAX_BUCKETS, HIST_BUDGET // len(big)))
            by_range = defaultdict(list)
            below_of = {}
            for rid, b, cnt, bmin, bmax in _range_scan(spark, lf, big, nb):
                if b < 0:
                    below_of[rid] = cnt
                else:
                    by_range[rid].append((b, cnt, bmin, bmax))
            for rid, rk in enumerate(big):
                buckets = sorted(by_range.get(rid, []))
                start = rk[4] if rk[4] is not None else below_of.get(rid, 0)
                total = sum(c for _, c, _, _ in buckets)
                for key in ranges[rk]:
                    k = key[2]
                    if not start <= k < start + total:
                        state[key] = list(full[(key[0], key[1])])   # bracket missed: widen
                        continue
                    below = start
                    for b, cnt, bmin, bmax in buckets:
                        if below + cnt > k:
                            break
                        below += cnt
                    state[key] = [bmin, bmax, below, bmin if bmin == bmax else None, cnt]
    out = {}
    for g, feat, p, gk, k0, k1, frac in needs:
        a = state[(gk, feat, k0)][3]
        b = state[(gk, feat, k1)][3]
        out[(g, feat, p)] = a if frac == 0 or a == b else a + frac * (b - a)
    return out


def _ranges_df(spark: SparkSession, rlist) -> DataFrame:
    schema = T.StructType([
        T.StructField("_rid", T.IntegerType()), T.StructField("_gk", T.StringType()),
        T.StructField("feature", T.StringType()), T.StructField("_lo", T.DoubleType()),
        T.StructField("_hi", T.DoubleType()), T.StructField("_bu", T.BooleanType()),
    ])
    return spark.createDataFrame([(i, r[0], r[1], float(r[2]), float(r[3]), r[4] is None)
                                  for i, r in enumerate(rlist)], schema)


def _in_scope(lf, rdf):
    """Rows inside each range, plus the rows below it when that count is unknown."""
    j = lf.join(rdf, ["_gk", "feature"])
    return j.where((F.col("v") <= F.col("_hi")) & ((F.col("v") >= F.col("_lo")) | F.col("_bu")))


def _range_scan(spark, lf, rlist, nb):
    """Histogram of the values inside each open range: (rid, bucket, count, min, max);
    bucket -1 counts the values below the range (only where that count is unknown)."""
    j = _in_scope(lf, F.broadcast(_ranges_df(spark, rlist)))
    half_w = F.col("_hi") / 2 - F.col("_lo") / 2
    pos = F.try_divide(F.col("v") / 2 - F.col("_lo") / 2, half_w)
    inside = F.least(F.floor(F.coalesce(pos, F.lit(0.0)) * nb), F.lit(nb - 1)).cast("int")
    b = F.when(F.col("v") < F.col("_lo"), F.lit(-1)).otherwise(inside)
    h = j.groupBy("_rid", b.alias("_b")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("mn"),
                                             F.max("v").alias("mx"))
    pdf = h.toPandas()  # Arrow batches: O(#ranges x B) small rows
    return list(zip(pdf["_rid"].tolist(), pdf["_b"].tolist(), pdf["c"].tolist(), pdf["mn"].tolist(),
                    pdf["mx"].tolist()))


def _range_values(spark, lf, ulist):
    """Distinct values (with counts) inside each small range, and the count below it."""
    j = _in_scope(lf, F.broadcast(_ranges_df(spark, ulist)))
    key = F.when(F.col("v") >= F.col("_lo"), F.col("v"))
    pdf = j.groupBy("_rid", key.alias("_v")).agg(F.count(F.lit(1)).alias("c")).toPandas()
    below, vals = {}, defaultdict(list)
    for rid, val, c in zip(pdf["_rid"].tolist(), pdf["_v"].tolist(), pdf["c"].tolist()):
        if val is None or (isinstance(val, float) and math.isnan(val)):
            below[rid] = c
        else:
            vals[rid].append((val, c))
    return below, vals


def quantiles(df: DataFrame, value_cols, probs, group_cols=(), *, exact: bool = True) -> DataFrame:
    """Long result: (group cols..., feature, p, value)."""
    spark = df.sparkSession
    vals = quantile_values(df, value_cols, probs, group_cols, exact=exact)
    gtypes = dict(df.dtypes)
    fields = [T.StructField(c, T._parse_datatype_string(gtypes[c])) for c in group_cols]
    fields += [T.StructField("feature", T.StringType()), T.StructField("p", T.DoubleType()),
               T.StructField("value", T.DoubleType())]
    rows = [(*g, f, p, v) for (g, f, p), v in vals.items()]
    return spark.createDataFrame(rows, T.StructType(fields))


def order_statistic_values(df: DataFrame, column: str, fractions, group_cols=()) -> dict:
    """{(group tuple, fraction): x_(k)} with k = floor(fraction * n) (0-based,
    clipped to n-1): the element at that position of the sorted column, as in
    ``sorted(x)[int(f * n)]``. Exact, distributed (same refinement)."""
    group_cols = list(group_cols)
    def fn(n):
        out = []
        for f in fractions:
            k = min(int(math.floor(f * n)), n - 1)
            out.append((f, k, k, 0.0))
        return out

    with kept(df.select(*group_cols, F.col(column).cast("double").alias(column))) as wide:
        lf = long_form(wide, [column], group_cols).withColumn("_gk", _gkey(group_cols)).select("_gk", *group_cols, "feature", "v")
        res = _exact(lf, group_cols, [column], [], targets_fn=fn, fractions=fractions)
    return {(g, f): val for (g, _feat, f), val in res.items()}
