"""Calendar scalar functions as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LATE_NIGHT_HOURS, LOCAL_TZ, RUSH_HOURS


def as_utc_timestamp(col) -> Column:
    """Naive (TIMESTAMP_NTZ) or string times are taken as UTC instants."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp")


def local_time(col, tz: str = LOCAL_TZ) -> Column:
    """Wall clock of a UTC instant in ``tz`` (session time zone must be UTC)."""
    ts = as_utc_timestamp(col)
    if tz.upper() == "UTC":
        return ts
    return F.from_utc_timestamp(ts, tz)


def calendar_columns(col, tz: str = LOCAL_TZ) -> dict[str, Column]:
    """pickup_hour, pickup_dow (0 = Monday), pickup_month, pickup_year."""
    if isinstance(col, str):
        ts = f"CAST(`{col}` AS TIMESTAMP)"
        lt = ts if tz.upper() == "UTC" else f"from_utc_timestamp({ts}, '{tz}')"
        return {"pickup_hour": F.expr(f"hour({lt})"), "pickup_dow": F.expr(f"weekday({lt})"),
                "pickup_month": F.expr(f"month({lt})"), "pickup_year": F.expr(f"year({lt})")}
    lt = local_time(col, tz)
    return {
        "pickup_hour": F.hour(lt),
        "pickup_dow": F.weekday(lt),
        "pickup_month": F.month(lt),
        "pickup_year": F.year(lt),
    }


def flag_columns(hour: str = "pickup_hour", dow: str = "pickup_dow") -> dict[str, Column]:
    rush = ", ".join(str(h) for h in RUSH_HOURS)
    late = ", ".join(str(h) for h in LATE_NIGHT_HOURS)
    return {
        "is_weekend": F.expr(f"CAST(`{dow}` >= 5 AS INT)"),
        "is_rush_hour": F.expr(f"CAST(`{hour}` IN ({rush}) AS INT)"),
        "is_late_night": F.expr(f"CAST(`{hour}` IN ({late}) AS INT)"),
    }


def cyclic_columns(hour: str = "pickup_hour", dow: str = "pickup_dow") -> dict[str, Column]:
    two_pi = f"CAST({2 * math.pi!r} AS DOUBLE)"
    return {
        "hour_sin": F.expr(f"sin({two_pi} * `{hour}` / 24)"),
        "hour_cos": F.expr(f"cos({two_pi} * `{hour}` / 24)"),
        "dow_sin": F.expr(f"sin({two_pi} * `{dow}` / 7)"),
        "dow_cos": F.expr(f"cos({two_pi} * `{dow}` / 7)"),
    }
