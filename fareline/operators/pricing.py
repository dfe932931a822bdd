"""Pricing rules (PRC-*): clamps, bands and flags as Column expressions.

The reference walks trips one row at a time in Python; here every rule is
a ``when`` chain evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import round_half_even_exact
from ..config import (DEFAULT_RULES, FALLBACK_BAND, FALLBACK_FARE, FARE_BANDS, FLAG_AIRPORT, FLAG_NORMAL,
                      FLAG_SURGE, SURGE_MIN_DISTANCE_KM, TripRules)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp_fare(fare, rules: TripRules = DEFAULT_RULES) -> Column:
    """PRC-1: clamp to [min_fare, max_fare]; NULL stays NULL."""
    f = _c(fare)
    return F.when(f.isNotNull() & ~F.isnan(f), F.greatest(F.least(f, F.lit(rules.max_fare)), F.lit(rules.min_fare)))


def fare_band(fare, bands=FARE_BANDS, fallback: str = FALLBACK_BAND) -> Column:
    """PRC-2: half-open bands [lo, hi); anything else (negative, huge, NULL) -> fallback."""
    f = _c(fare)
    expr = None
    for name, lo, hi in bands:
        cond = (f >= lo) & (f < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(fallback))


def pricing_flag(normal_label: str | None = FLAG_NORMAL, *, airport: str = "airport_trip",
                 rush: str = "is_rush_hour", distance: str = "trip_distance_km") -> Column:
    """PRC-3/PRC-4: airport -> AIRPORT_FLAT_CANDIDATE; rush and distance > 5 km ->
    SURGE_ELIGIBLE; else ``normal_label`` (NORMAL in batch, NULL for one trip).
    A missing input counts as 0."""
    a = F.coalesce(F.col(airport), F.lit(0))
    r = F.coalesce(F.col(rush), F.lit(0))
    d = F.coalesce(F.col(distance), F.lit(0))
    other = F.lit(normal_label) if normal_label is not None else F.lit(None).cast("string")
    return F.when(a == 1, FLAG_AIRPORT).when((r == 1) & (d > SURGE_MIN_DISTANCE_KM), FLAG_SURGE).otherwise(other)


FLAG_INPUTS = ("airport_trip", "is_rush_hour", "trip_distance_km")


def with_flag_inputs(df: DataFrame) -> DataFrame:
    """A trip without an airport / rush / distance column counts as 0 there."""
    missing = {c: F.lit(0) for c in FLAG_INPUTS if c not in df.columns}
    return df.withColumns(missing) if missing else df


def price_trips(df: DataFrame, prediction: str = "predicted_fare", rules: TripRules = DEFAULT_RULES,
                normal_label: str | None = FLAG_NORMAL) -> DataFrame:
    """Batch pricing: clamped fare, band of the clamped (unrounded) fare, flag."""
    df = with_flag_inputs(df)
    clamped = clamp_fare(prediction, rules)
    return df.withColumns({"clamped_fare": clamped, "fare_band": fare_band(clamped),
                           "pricing_flag": pricing_flag(normal_label)})


def score_columns(prediction: str = "predicted_fare", lower: str | None = None, upper: str | None = None,
                  rules: TripRules = DEFAULT_RULES, fallback_fare: float | None = FALLBACK_FARE) -> dict:
    """PRC-4/PRC-5 single-trip output: fare rounded half-even to cents, band,
    flag (NULL instead of NORMAL), interval rounded to cents when both bounds
    exist. A missing prediction (model failure) falls back to 15.0."""
    pred = _c(prediction)
    if fallback_fare is not None:
        pred = F.coalesce(pred, F.lit(fallback_fare))
    clamped = clamp_fare(pred, rules)
    out = {"predicted_fare_usd": round_half_even_exact(clamped, 2), "fare_band": fare_band(clamped),
           "pricing_flag": pricing_flag(None)}
    if lower is not None and upper is not None:
        both = F.col(lower).isNotNull() & F.col(upper).isNotNull()
        out["interval_lo"] = F.when(both, round_half_even_exact(lower, 2))
        out["interval_hi"] = F.when(both, round_half_even_exact(upper, 2))
    return out


TOO_LONG = "DISTANCE_ABOVE_LIMIT"
NO_DISTANCE = "NO_DISTANCE"


def score_every_trip(df: DataFrame, prediction: str = "prediction", lower: str | None = None, upper: str | None = None,
                     rules: TripRules = DEFAULT_RULES, distance: str = "trip_distance_km") -> dict:
    """PRC-5 for every row: the score columns, NULL for a trip that no price is
    made for, and ``unpriced_reason`` (NULL for priced trips)."""
    d = F.col(distance)
    reason = F.when(d.isNull(), NO_DISTANCE).when(d > rules.max_trip_km, TOO_LONG)
    out = {k: F.when(reason.isNull(), c) for k, c in score_columns(prediction, lower, upper, rules).items()}
    return {**out, "unpriced_reason": reason}


def band_table(spark, bands=FARE_BANDS) -> DataFrame:
    return spark.createDataFrame([(n, float(lo), float(hi)) for n, lo, hi in bands],
                                 "band string, lo double, hi double")


def band_by_range_join(df: DataFrame, fare: str, bands: DataFrame, fallback: str = FALLBACK_BAND) -> DataFrame:
    """JN-3: band lookup as a non-equi left join to a (tiny, broadcast) band table."""
    b = F.broadcast(bands.select(F.col("band").alias("_band"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi")))
    j = df.join(b, (F.col(fare) >= F.col("_lo")) & (F.col(fare) < F.col("_hi")), "left")
    return j.withColumn("fare_band", F.coalesce(F.col("_band"), F.lit(fallback))).drop("_band", "_lo", "_hi")
