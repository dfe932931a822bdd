"""Registered queries: one per operator, each with its DuckDB oracle text.

``register(name, sql=...)`` records a builder ``fn(spark, sf_dir) -> DataFrame``
and (when the operator is SQL-expressible) the equivalent DuckDB query
over the same parquet tables. Column names match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def load_all() -> dict:
    # importing the family modules fills REGISTRY
    from . import (  # noqa: F401
        calibration, geo_calendar, metrics, models, monitoring, prep, pricing, profiling,
        sources, streaming_twins, validation,
    )
    return REGISTRY
