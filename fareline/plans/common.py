"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DP = 6


def rnd(c, d: int = DP) -> Column:
    """Round a double for engine-independent comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def sql_round_half_even_exact(expr: str, digits: int) -> str:
    """DuckDB text of ``functions.stats.round_half_even_exact`` (same double
    arithmetic: Dekker two-product, then half-even on the exact fraction)."""
    sc = f"{float(10 ** digits)!r}e0" if "e" not in repr(float(10 ** digits)) else repr(float(10 ** digits))
    c = f"({expr})"
    t = f"(134217729e0 * {c})"
    hi = f"({t} - ({t} - {c}))"
    lo = f"({c} - {hi})"
    p = f"({c} * {sc})"
    err = f"(({hi} * {sc} - {p}) + {lo} * {sc})"
    f0 = f"CAST(floor({p}) AS DOUBLE)"
    frac0 = f"(({p} - {f0}) + {err})"
    f = f"(CASE WHEN {frac0} < 0 THEN {f0} - 1 ELSE {f0} END)"
    frac = f"(CASE WHEN {frac0} < 0 THEN {frac0} + 1 ELSE {frac0} END)"
    r = (f"(CASE WHEN {frac} > 0.5 THEN {f} + 1 WHEN {frac} < 0.5 THEN {f} "
         f"WHEN {f} - 2 * floor({f} / 2) = 0 THEN {f} ELSE {f} + 1 END)")
    return f"(CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) AND abs({c}) < 1e15 THEN {r} / {sc} ELSE {c} END)"
