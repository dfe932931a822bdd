"""Bias corrections and small statistics helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(x) -> Column:
    """Bias-corrected (Fisher-Pearson adjusted) skewness, as pandas ``skew``.

    Spark's ``skewness`` is the population form g1; G1 = g1 * sqrt(n(n-1))/(n-2).
    Null when n < 3 or the column is constant.
    """
    c = F.col(x) if isinstance(x, str) else x
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(x) -> Column:
    """Bias-corrected excess kurtosis, as pandas ``kurt``.

    G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6) with Spark's excess g2.
    """
    c = F.col(x) if isinstance(x, str) else x
    n = F.count(c).cast("double")
    g2 = F.kurtosis(c)
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def safe_corr(x, y) -> Column:
    """Pearson r that is NULL (not an ANSI error) for a constant column."""
    cx = F.col(x) if isinstance(x, str) else x
    cy = F.col(y) if isinstance(y, str) else y
    return F.try_divide(F.covar_pop(cx, cy), F.stddev_pop(cx) * F.stddev_pop(cy))


def hash_unit(*cols, seed: str = "42") -> Column:
    """Deterministic uniform number in [0, 2^32) from the md5 of the key.

    Unlike ``rand``/``randomSplit`` it does not depend on partitioning, and
    the same formula runs in DuckDB (``('0x' || substr(md5(k),1,8))::BIGINT``).
    """
    key = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols], F.lit(seed))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def round_half_even_exact(x, digits: int) -> Column:
    """Half-even rounding on the exact binary value of a double (as Python's
    ``round`` and DuckDB ``round_even`` do), not on its shortest decimal text
    (Spark ``bround``: 147.575 -> 147.58, although the stored double is
    147.57499999999998863...).

    x * 10^d is formed exactly as p + err with Dekker's two-product (double
    arithmetic only, so it stays in codegen); the fraction p + err - floor(p)
    then decides the direction, and an exact tie goes to the even integer.
    """
    c = F.col(x) if isinstance(x, str) else x
    scale = float(10 ** digits)
    split = F.lit(134217729.0)  # 2^27 + 1
    t = split * c
    hi = t - (t - c)
    lo = c - hi
    p = c * scale
    err = (hi * scale - p) + lo * scale
    f0 = F.floor(p).cast("double")
    frac0 = (p - f0) + err
    f = F.when(frac0 < 0, f0 - 1).otherwise(f0)
    frac = F.when(frac0 < 0, frac0 + 1).otherwise(frac0)
    is_even = F.pmod(f, F.lit(2.0)) == 0
    r = (F.when(frac > 0.5, f + 1).when(frac < 0.5, f)
         .otherwise(F.when(is_even, f).otherwise(f + 1)))
    finite = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e15)
    return F.when(finite, r / scale).otherwise(c)


def stack_sql(columns, key: str = "feature", value: str = "v", cast: str | None = "DOUBLE") -> str:
    """SQL text unpivoting ``columns`` into (key, value) rows with ``stack``:
    one generator expression sent to the JVM in one call."""
    parts = []
    for c in columns:
        val = f"CAST(`{c}` AS {cast})" if cast else f"`{c}`"
        parts.append(f"'{c}', {val}")
    return f"stack({len(columns)}, {', '.join(parts)}) AS (`{key}`, `{value}`)"
