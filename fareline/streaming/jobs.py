"""Structured Streaming jobs (ST-1..ST-4).

The online path of the reference (one HTTP request scored and appended to a
CSV log; alerts recomputed on each dashboard load) becomes streaming
queries over a file source: the same Column expressions as the batch
operators, event-time watermarks for late data, exactly-once file sinks
with checkpoints in the shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FLAG_SURGE
from ..operators import features as ft
from ..operators import validate as val

TRIP_KEY = ("fare_amount", "pickup_datetime", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
            "dropoff_latitude", "passenger_count")


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Process everything available, exactly once, into a file sink; waits for
    as long as that takes. A failed query raises."""
    q = (stream.writeStream.format(fmt).outputMode(mode).option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def with_event_time(df: DataFrame, col: str = "pickup_datetime", out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); naive times are UTC."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def dedup_stream(stream: DataFrame, delay: str = "10 minutes", keys=TRIP_KEY) -> DataFrame:
    """ST-3: at-least-once replays removed within the watermark (state is
    evicted once the watermark passes, so it stays bounded)."""
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))


def clean_stream(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Row rules (VAL-4..8) + replay dedup on a stream."""
    s = val.apply_rules(val.require_columns(stream))
    return dedup_stream(s, delay, keys=list(s.columns))


def clean_feature_stream(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """``clean_stream`` + FT-0."""
    s = clean_stream(stream, delay)
    return ft.add_engineered_features(s.drop("event_time")).withColumn(
        "event_time", F.col("pickup_datetime").cast("timestamp"))


def window_kpis(stream: DataFrame, window: str = "1 hour", slide: str | None = None,
                delay: str = "10 minutes") -> DataFrame:
    """ST-2: MON-1/2/4 per event-time window; late rows (older than the
    watermark) are dropped; a window is emitted once the watermark passes
    its end (append mode)."""
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    err = F.abs(F.col("predicted_fare") - F.col("actual_fare"))
    return (stream.withWatermark("event_time", delay).groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(err / F.greatest(F.col("actual_fare"), F.lit(1e-6))).alias("mape"),
                 F.avg((F.col("pricing_flag") == FLAG_SURGE).cast("double")).alias("surge_rate"),
                 F.avg("predicted_fare").alias("avg_predicted_fare"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mape",
                    "surge_rate", "avg_predicted_fare"))


def session_kpis(stream: DataFrame, keys, gap: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """ST-2: sessions of rows of one key, each within ``gap`` of the one before; a session is
    emitted once the watermark passes its last row by the gap, so its state goes then."""
    w = F.session_window("event_time", gap)
    return (stream.withWatermark("event_time", delay).groupBy(*keys, w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("predicted_fare").alias("predicted"), F.sum("actual_fare").alias("actual"))
            .select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "predicted", "actual"))


def drift_batches(stream: DataFrame, edges: dict, columns, sink: str, checkpoint: str) -> None:
    """ST-4: per micro-batch PSI of each column against stored reference
    edges and shares (``edges`` = {column: (edges list, expected shares)}),
    appended to a drift table by ``foreachBatch``."""
    import math

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = []
        entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])
        long = batch.select(F.inline(entries)).where(F.col("x").isNotNull())
        eds = spark.createDataFrame([(c, [float(x) for x in edges[c][0]]) for c in columns],
                                    "feature string, edges array<double>")
        m = F.size("edges")
        b = F.greatest(F.lit(1), F.least(F.size(F.filter("edges", lambda e: e <= F.col("x"))), m - 1))
        counts = long.join(F.broadcast(eds), "feature").groupBy("feature", b.alias("bin")).count().collect()
        tot = {}
        cnt = {}
        for r in counts:
            cnt[(r["feature"], r["bin"])] = r["count"]
            tot[r["feature"]] = tot.get(r["feature"], 0) + r["count"]
        for c in columns:
            e, shares = edges[c]
            if len(e) < 2 or not tot.get(c):
                continue
            s = 0.0
            for bn in range(1, len(e)):
                ex = shares[bn - 1] or 1e-6
                ac = cnt.get((c, bn), 0) / (tot[c] + 1e-9) or 1e-6
                s += (ex - ac) * math.log(ex / ac)
            rows.append((c, float(s), int(tot[c])))
        if rows:
            # one folder per batch id, overwritten on replay: idempotent, so the
            # at-least-once foreachBatch becomes exactly-once in the table
            spark.createDataFrame(rows, "feature string, drift_score double, n bigint") \
                .write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={int(batch_id)}"))

    q = (stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()      # raises when the query failed


def sink_dir(base: str, name: str) -> tuple[str, str]:
    return os.path.join(base, name, "data"), os.path.join(base, name, "_checkpoint")
