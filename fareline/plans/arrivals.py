"""Files that arrive in event-time order, for the queries whose result depends on the watermark between micro-batches
(windows, sessions, late rows, per-batch drift). Not part of the streaming jobs: a cluster's files arrive by themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import prep as pp
from ..operators.quantiles import kept


def time_slices(df: DataFrame, ts: str, chunks: int):
    """Split ``df`` into ``chunks`` consecutive event-time slices (bounds are
    exact order statistics of ``ts``); yields one filtered DataFrame per slice."""
    fr = [i / chunks for i in range(1, chunks)]
    cuts = pp.time_cutoffs(df, ts, fr) if fr else {}
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    bounds = [None] + [cuts[f] for f in fr] + [None]
    for i in range(chunks):
        cond = F.lit(True)
        if bounds[i] is not None:
            cond = cond & (us > bounds[i])
        if bounds[i + 1] is not None:
            cond = cond & (us <= bounds[i + 1])
        yield df.where(cond)


def feed_in_slices(df: DataFrame, ts: str, chunks: int, src: str, run, extra: DataFrame | None = None) -> None:
    """Incremental ingestion: append one event-time slice to the source
    folder, then let the stream process everything new (``run()``, an
    availableNow trigger on the same checkpoint); repeat. ``extra`` (e.g. a
    replay of old rows) arrives after all slices."""
    # the source is scanned once per slice bound and once per slice: write it once
    with kept(df) as whole:
        for part in time_slices(whole, ts, chunks):
            part.write.mode("append").parquet(src)
            run()
    if extra is not None:
        extra.write.mode("append").parquet(src)
        run()
