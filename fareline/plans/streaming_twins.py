"""Streaming queries (ST-*) and their batch-twin oracles.

Each query runs its streaming job with ``trigger(availableNow=True)`` into a file sink and returns the sink.
Where the result does not depend on the order of arrival the stream reads the written trip files as they are; windows, sessions,
late rows and per-batch drift read files that arrive slice by slice (``arrivals``), the query going on from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as met
from ..operators import prep as pp
from ..session import scratch_path
from ..sources.prediction_log import read_prediction_log, write_prediction_log
from ..streaming import jobs
from . import register
from . import views as v
from .arrivals import feed_in_slices
from .common import rnd
from .prep import SPLIT_SQL
from .pricing import SCORED_SQL, scored

CHUNKS = 4


@register("st_dedup", v.with_views("SELECT DISTINCT * FROM trips", "trips"))
def _st_dedup(spark, sf):
    """ST-3: replayed trips removed by dropDuplicatesWithinWatermark on a file stream."""
    sink, ckpt = jobs.sink_dir(scratch_path(spark, "st-dedup"), "out")
    src, schema = v.trips_path(spark, sf)
    stream = jobs.with_event_time(jobs.read_stream(spark, src, schema))
    jobs.run_available_now(jobs.dedup_stream(stream).drop("event_time"), sink, ckpt)
    return spark.read.parquet(sink).select(*schema.names)


_KPI_SQL = SCORED_SQL + """
, s2 AS (SELECT s.*, c.pickup_datetime FROM scored s JOIN clean_trips c USING (event_id)),
win AS (SELECT date_trunc('hour', pickup_datetime) AS ws, count(*) AS n,
          avg(abs(predicted_fare - actual_fare) / greatest(actual_fare, 1e-6)) AS mape,
          avg(CAST(pricing_flag = 'SURGE_ELIGIBLE' AS DOUBLE)) AS surge_rate
        FROM s2 GROUP BY 1)
SELECT epoch_us(ws) AS window_start_us, n, round(mape, 6) AS mape, round(surge_rate, 6) AS surge_rate FROM win
WHERE ws + INTERVAL 1 HOUR <= (SELECT max(pickup_datetime) FROM s2) - INTERVAL 10 MINUTE"""


_SLIDE_SQL = SCORED_SQL + """
, s2 AS (SELECT s.*, c.pickup_datetime FROM scored s JOIN clean_trips c USING (event_id)),
win AS (SELECT time_bucket(INTERVAL 30 MINUTE, pickup_datetime) - k * INTERVAL 30 MINUTE AS ws, count(*) AS n,
          avg(abs(predicted_fare - actual_fare) / greatest(actual_fare, 1e-6)) AS mape,
          avg(CAST(pricing_flag = 'SURGE_ELIGIBLE' AS DOUBLE)) AS surge_rate
        FROM s2, (SELECT unnest([0, 1]) AS k) GROUP BY 1)
SELECT epoch_us(ws) AS window_start_us, n, round(mape, 6) AS mape, round(surge_rate, 6) AS surge_rate FROM win
WHERE ws + INTERVAL 1 HOUR <= (SELECT max(pickup_datetime) FROM s2) - INTERVAL 10 MINUTE"""


def _kpi_stream(spark, sf, late: bool, slide: str | None = None):
    base = scratch_path(spark, "st-kpi")
    src, (sink, ckpt) = f"{base}/source", jobs.sink_dir(base, "out")
    s = scored(spark, sf).select("event_id", "pickup_datetime", "actual_fare", "predicted_fare", "pricing_flag")

    def run():
        stream = jobs.with_event_time(jobs.read_stream(spark, src, s.schema))
        jobs.run_available_now(jobs.window_kpis(stream, slide=slide), sink, ckpt)

    # late: a replay of the first day arriving after the watermark has passed it
    first = s.agg(F.to_date(F.min("pickup_datetime"))).first()[0] if late else None
    extra = s.where(F.to_date("pickup_datetime") == F.lit(first)) if late else None
    feed_in_slices(s, "pickup_datetime", CHUNKS, src, run, extra)
    out = spark.read.parquet(sink)
    return out.select(F.unix_micros("window_start").alias("window_start_us"), "n", rnd("mape").alias("mape"),
                      rnd("surge_rate").alias("surge_rate"))


@register("st_window_kpis", v.with_views(_KPI_SQL, "features", "pairs", "clean_trips"))
def _st_kpis(spark, sf):
    """ST-2: hourly tumbling-window MAPE / surge rate with a 10-minute watermark."""
    return _kpi_stream(spark, sf, late=False)


@register("st_sliding_kpis", v.with_views(_SLIDE_SQL, "features", "pairs", "clean_trips"))
def _st_sliding(spark, sf):
    """ST-2: one-hour windows that start every 30 minutes, 10-minute watermark."""
    return _kpi_stream(spark, sf, late=False, slide="30 minutes")


@register("st_late_rows", v.with_views(_KPI_SQL, "features", "pairs", "clean_trips"))
def _st_late(spark, sf):
    """ST-2 late data: a replayed old day arrives last and is dropped by the watermark
    (the result equals the on-time windows)."""
    return _kpi_stream(spark, sf, late=True)


_SESSION_SQL = SCORED_SQL + """
, s2 AS (SELECT s.*, c.pickup_datetime AS t, c.passenger_count FROM scored s JOIN clean_trips c USING (event_id)),
g AS (SELECT *, CASE WHEN t - lag(t) OVER w < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS fresh FROM s2 WINDOW w AS (PARTITION BY passenger_count ORDER BY t, event_id)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY passenger_count ORDER BY t, event_id) AS session FROM g),
x AS (SELECT passenger_count, min(t) AS b, max(t) + INTERVAL 10 MINUTE AS e, count(*) AS n, sum(predicted_fare) AS predicted, sum(actual_fare) AS actual
      FROM i GROUP BY passenger_count, session)
SELECT passenger_count, epoch_us(b) AS session_start_us, epoch_us(e) AS session_end_us, n, round(predicted, 4) AS predicted, round(actual, 4) AS actual
FROM x WHERE e <= (SELECT max(t) FROM s2) - INTERVAL 10 MINUTE"""


@register("st_session_kpis", v.with_views(_SESSION_SQL, "features", "pairs", "clean_trips"))
def _st_sessions(spark, sf):
    """ST-2: sessions of trips with one passenger count, each within 10 minutes of the one before, 10-minute watermark."""
    base = scratch_path(spark, "st-session")
    src, (sink, ckpt) = f"{base}/source", jobs.sink_dir(base, "out")
    s = scored(spark, sf).select("event_id", "pickup_datetime", "passenger_count", "actual_fare", "predicted_fare")

    def run():
        stream = jobs.with_event_time(jobs.read_stream(spark, src, s.schema))
        jobs.run_available_now(jobs.session_kpis(stream, ["passenger_count"]), sink, ckpt)

    feed_in_slices(s, "pickup_datetime", CHUNKS, src, run)
    out = spark.read.parquet(sink)
    return out.select("passenger_count", F.unix_micros("session_start").alias("session_start_us"), F.unix_micros("session_end").alias("session_end_us"),
                      "n", F.round("predicted", 4).alias("predicted"), F.round("actual", 4).alias("actual"))


@register("st_scoring")
def _st_scoring(spark, sf):
    """ST-1 + SNK-4: raw trip stream -> rules + replay dedup + FT-0 -> fitted model -> pricing
    output, appended exactly once to a prediction log with the reference's log layout
    (epoch-seconds timestamp, ISO pickup time, passengers, fare, band, flag)."""
    from ..operators import pricing as prc
    from .models import fitted

    model, prep, _f = fitted(spark, sf, "linear")
    sink, ckpt = jobs.sink_dir(scratch_path(spark, "st-score"), "out")
    src, schema = v.trips_path(spark, sf)
    stream = jobs.clean_feature_stream(jobs.with_event_time(jobs.read_stream(spark, src, schema)))
    cols = prc.score_columns("prediction")
    out = model.transform(prep.transform(stream)).select(
        F.unix_micros(F.current_timestamp()).cast("double").__truediv__(1e6).alias("timestamp"),
        F.date_format(F.col("pickup_datetime").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("pickup_datetime"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        cols["predicted_fare_usd"].alias("predicted_fare_usd"), cols["fare_band"].alias("fare_band"),
        cols["pricing_flag"].alias("pricing_flag"), "event_id")
    write_prediction_log(out, sink, ckpt)
    return read_prediction_log(spark, sink, out.schema)


@register("st_drift")
def _st_drift(spark, sf):
    """ST-4: per-micro-batch PSI against edges / shares stored from the first half of the month."""
    from .metrics import PSI_COLS

    f = v.features(spark, sf)
    is_exp = F.col("pickup_datetime") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    ref = f.where(is_exp)
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in PSI_COLS])
    long = ref.select(F.inline(entries)).where(F.col("v").isNotNull())
    edges = met.psi_edges(long, PSI_COLS)
    # reference shares per bin (one aggregate)
    eds = spark.createDataFrame([(c, [float(x) for x in e]) for c, e in edges.items()], "feature string, edges array<double>")
    m = F.size("edges")
    b = F.greatest(F.lit(1), F.least(F.size(F.filter("edges", lambda e: e <= F.col("v"))), m - 1))
    cnt = long.join(F.broadcast(eds), "feature").groupBy("feature", b.alias("bin")).count().collect()
    tot = {}
    for r in cnt:
        tot[r["feature"]] = tot.get(r["feature"], 0) + r["count"]
    shares = {c: [0.0] * max(len(edges[c]) - 1, 0) for c in PSI_COLS}
    for r in cnt:
        if 1 <= r["bin"] <= len(shares[r["feature"]]):
            shares[r["feature"]][r["bin"] - 1] = r["count"] / (tot[r["feature"]] + 1e-9)
    base = scratch_path(spark, "st-drift")
    src, (sink, ckpt) = f"{base}/source", jobs.sink_dir(base, "out")
    cur = f.where(~is_exp).select(*PSI_COLS, "pickup_datetime")

    def run():
        stream = jobs.read_stream(spark, src, cur.schema)
        jobs.drift_batches(stream, {c: (edges[c], shares[c]) for c in PSI_COLS}, PSI_COLS, sink, ckpt)

    feed_in_slices(cur, "pickup_datetime", CHUNKS, src, run)
    return spark.read.parquet(sink)


@register("spl_stream_hash_split", SPLIT_SQL)
def _stream_split(spark, sf):
    """SPL-1 on a stream: the hash split is a pure expression, so it is the same on every micro-batch."""
    sink, ckpt = jobs.sink_dir(scratch_path(spark, "st-split"), "out")
    src, schema = v.trips_path(spark, sf)
    clean = jobs.clean_stream(jobs.with_event_time(jobs.read_stream(spark, src, schema)))
    jobs.run_available_now(clean.select("event_id", pp.split_label().alias("split")), sink, ckpt)
    return spark.read.parquet(sink).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
