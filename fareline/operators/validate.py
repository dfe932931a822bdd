"""Validation: name normalisation, ordered row rules, de-duplication.

Rule order is part of the semantics: normalise -> drop ids -> required ->
nulls -> fare -> passengers -> box -> same point -> size check -> dedup.
All rules are narrow filters (pushed to the Parquet scan where they are
plain comparisons); the only shuffle is the final exact de-duplication,
which Spark runs as a partial (map-side) + final hash aggregate, so a row
repeated a billion times is collapsed on the map side before it can skew
one reducer.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RULES, ID_COLUMNS, REQUIRED_COLUMNS, TARGET, TripRules

_NON_ALNUM = re.compile(r"[^0-9a-zA-Z]+")


class ValidationError(ValueError):
    pass


def normalise_name(name: str) -> str:
    return _NON_ALNUM.sub("_", name.strip()).lower()


def normalise_columns(df: DataFrame) -> DataFrame:
    """VAL-1: strip, runs of non-alphanumerics -> '_', lower case."""
    new = [normalise_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValidationError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def drop_id_columns(df: DataFrame, ids=ID_COLUMNS) -> DataFrame:
    """VAL-2: drop key-like columns when present."""
    return df.drop(*[c for c in ids if c in df.columns])


def require_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """VAL-3: schema check on the driver (no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValidationError(f"Missing required columns: {missing}")
    return df


def _present(df_types: dict, c: str) -> str:
    """Not NULL and, for floating columns, not NaN (pandas treats NaN as missing)."""
    if df_types.get(c) in ("double", "float"):
        return f"(`{c}` IS NOT NULL AND NOT isnan(`{c}`))"
    return f"`{c}` IS NOT NULL"


def rule_columns(rules: TripRules = DEFAULT_RULES, types: dict | None = None) -> list[tuple[str, Column]]:
    """The ordered row rules as (reason, keep-condition) pairs.

    NaN fails every range rule by itself (NaN sorts above all numbers), so
    only the null rule needs an explicit NaN test.
    """
    r = rules
    types = types or {}

    def between(c, lo, hi):
        return f"`{c}` BETWEEN {lo!r} AND {hi!r}"

    box = " AND ".join([between("pickup_latitude", r.min_lat, r.max_lat), between("dropoff_latitude", r.min_lat, r.max_lat),
                        between("pickup_longitude", r.min_lon, r.max_lon),
                        between("dropoff_longitude", r.min_lon, r.max_lon)])
    return [
        ("null_required", F.expr(" AND ".join(_present(types, c) for c in REQUIRED_COLUMNS))),
        ("fare_range", F.expr(between(TARGET, r.min_fare, r.max_fare))),
        ("passenger_range", F.expr(between("passenger_count", r.min_passengers, r.max_passengers))),
        ("outside_box", F.expr(box)),
        ("same_point", F.expr("NOT (pickup_latitude = dropoff_latitude AND pickup_longitude = dropoff_longitude)")),
    ]


def apply_rules(df: DataFrame, rules: TripRules = DEFAULT_RULES) -> DataFrame:
    """VAL-4..VAL-8 as one conjunctive filter (no action)."""
    cond = F.lit(True)
    for _, keep in rule_columns(rules, dict(df.dtypes)):
        cond = cond & keep
    return df.where(cond)


def validate_trips(df: DataFrame, rules: TripRules = DEFAULT_RULES, *,
                   check_size: bool = True, dedup: bool = True) -> DataFrame:
    """Full validation (VAL-1..VAL-10) in the published order.

    The size check (VAL-9) counts the filtered rows *before* dedup; it is
    one extra scan (an action) and is skipped with ``check_size=False`` or
    ``rules.min_rows=None``.
    """
    df = require_columns(drop_id_columns(normalise_columns(df)))
    df = apply_rules(df, rules)
    if check_size and rules.min_rows is not None:
        n = df.count()
        if n < rules.min_rows:
            raise ValidationError(
                f"Dataset too small for training after cleaning ({n} < {rules.min_rows} rows)")
    if dedup:
        df = df.dropDuplicates()
    return df


def reject_reasons(df: DataFrame, rules: TripRules = DEFAULT_RULES) -> DataFrame:
    """VAL-11: per-rule dropped-row counts in one pass.

    Each row is tagged with its first failing rule ('kept' when none); rejected
    rows are only counted. Among kept rows every copy beyond the first of an
    identical row is reported as 'duplicate': kept rows are compared by two
    64-bit hashes of the whole row (128 bits), so what is shuffled is a pair of
    longs per distinct kept row, not the row. Returns (reject_reason, n_rows).
    """
    reason = F.lit("kept")
    for name, keep in reversed(rule_columns(rules, dict(df.dtypes))):
        reason = F.when(~F.coalesce(keep, F.lit(False)), F.lit(name)).otherwise(reason)
    row = [F.struct(F.col(c).isNull(), F.col(c)) for c in df.columns]
    kept = F.col("reject_reason") == "kept"
    tagged = df.select(reason.alias("reject_reason"), *[
        F.when(reason == "kept", F.xxhash64(F.lit(i), *row)).alias(f"_h{i}") for i in (0, 1)])
    per = tagged.groupBy("reject_reason", "_h0", "_h1").agg(F.count(F.lit(1)).alias("_n")).groupBy("reject_reason").agg(
        F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_distinct"))
    entries = F.array(
        F.struct(F.col("reject_reason").alias("r"), F.when(kept, F.col("_distinct")).otherwise(F.col("_total")).alias("n")),
        F.struct(F.lit("duplicate").alias("r"), F.when(kept, F.col("_total") - F.col("_distinct")).alias("n")),
    )
    out = per.select(F.inline(entries)).where(F.col("n").isNotNull())
    return out.select(F.col("r").alias("reject_reason"), F.col("n").cast("bigint").alias("n_rows"))


def business_key_duplicates(df: DataFrame, keys=REQUIRED_COLUMNS) -> DataFrame:
    """VAL-12: number of rows that repeat the 7 trip columns (key excluded)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
                 F.count(F.lit(1)).alias("distinct_trips"))


def drop_business_duplicates(df: DataFrame, keys=REQUIRED_COLUMNS, order_by: str | None = None) -> DataFrame:
    """Keep one row per business key; ``order_by`` picks a deterministic survivor
    (the row with the smallest ``order_by``).

    Written as an aggregate (``min_by`` of the whole row), not a window: the
    survivor is chosen partially on the map side, so a key repeated by a
    third of all rows never lands in one task."""
    if order_by is None:
        return df.dropDuplicates(list(keys))
    others = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order_by)).alias("_row"))
    return g.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)
