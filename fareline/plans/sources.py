"""Queries for sources, samples and sinks (SRC-*, SNK-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import hash_unit
from ..operators import metrics as met
from ..operators import models as md
from ..operators import monitor as mon
from ..operators import prep as pp
from ..operators import pricing as prc
from ..operators import quantiles as qt
from ..operators import validate as val
from ..session import scratch_path
from ..sources import files
from . import register
from . import views as v
from .common import rnd
from .metrics import _psi_sql, PSI_COLS
from .models import RULES_SQL, fitted, rule_summary, written_table
from .monitoring import _REPLAY_ORACLE, HASH_SQL, daily_runs, replay
from .pricing import SCORED_SQL, scored

TRIP_COLS = ("event_id, event_type, fare_amount, pickup_datetime, pickup_longitude, pickup_latitude, "
             "dropoff_longitude, dropoff_latitude, passenger_count")
HASH32 = "('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), '42')), 1, 8))::BIGINT"


@register("src_first_n", v.with_views(f"SELECT {TRIP_COLS} FROM trips ORDER BY event_id, fare_amount LIMIT 1000", "trips"))
def _first_n(spark, sf):
    """SRC-2: the first 1,000 trips in event order (nrows)."""
    t = v.trips(spark, sf)
    return files.first_n(t, 1000, ["event_id", "fare_amount"])


@register("src_sample_fraction", v.with_views(f"SELECT {TRIP_COLS} FROM trips WHERE {HASH32} < 429496729", "trips"))
def _sample_frac(spark, sf):
    """SRC-3: reproducible 10% Bernoulli sample over the whole table (hash threshold)."""
    t = v.trips(spark, sf)
    return t.where(hash_unit("event_id") < 429496729)


@register("src_sample_n", v.with_views(f"SELECT {TRIP_COLS} FROM trips ORDER BY {HASH32}, event_id, fare_amount LIMIT 1000", "trips"))
def _sample_n(spark, sf):
    """SRC-5: fixed-size (1,000) sample without replacement: hash-order top-k."""
    t = v.trips(spark, sf)
    # duplicated trips share the key hash: break ties on the fare as well
    return t.orderBy(hash_unit("event_id"), "event_id", "fare_amount").limit(1000)


REPLACEMENT_N = 2000
_U32 = "('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), '7')), 1, 8))::BIGINT / 4294967296e0"


@register("src_sample_replacement", v.with_views(f"""
, l AS (SELECT {REPLACEMENT_N}e0 / count(*) AS lam FROM clean_trips),
t AS (SELECT k, exp(-lam) * list_sum(list_transform(range(0, k + 1), lambda j: pow(lam, j) / gamma(j + 1))) AS c
      FROM l, (SELECT unnest(range(0, 120)) AS k)),
n AS (SELECT event_id, fare_amount, count(*) FILTER (WHERE t.c <= u) AS times
      FROM (SELECT event_id, fare_amount, {_U32} AS u FROM clean_trips) x, t GROUP BY 1, 2)
SELECT event_id, fare_amount, CAST(unnest(range(1, times + 1)) AS INTEGER) AS copy FROM n""", "clean_trips"))
def _sample_repl(spark, sf):
    """SRC-6: with-replacement sample of about 2,000 rows: each row is taken a Poisson number of
    times, by a hash of its key (so it depends neither on partitions nor on retries)."""
    return pp.sample_with_replacement(v.clean_trips(spark, sf), REPLACEMENT_N).select("event_id", "fare_amount", "copy")


@register("src_stratified", v.with_views(f"""
, q AS (SELECT quantile_cont(fare_amount, 0.25) AS q1, quantile_cont(fare_amount, 0.5) AS q2, quantile_cont(fare_amount, 0.75) AS q3 FROM clean_trips),
b AS (SELECT c.*, CASE WHEN fare_amount <= q1 THEN 0 WHEN fare_amount <= q2 THEN 1 WHEN fare_amount <= q3 THEN 2 ELSE 3 END AS stratum FROM clean_trips c, q)
SELECT stratum, count(*) AS n FROM b
WHERE {HASH_SQL.replace('% 100', '% 1000')} < CASE stratum WHEN 0 THEN 100 WHEN 1 THEN 200 WHEN 2 THEN 300 ELSE 500 END
GROUP BY stratum""", "clean_trips"))
def _stratified(spark, sf):
    """SRC-7: stratified sample on fare-quartile strata (10/20/30/50%), hash form of sampleBy."""
    c = v.clean_trips(spark, sf)
    q = qt.quantile_values(c, ["fare_amount"], [0.25, 0.5, 0.75])
    q1, q2, q3 = (q[((), "fare_amount", p)] for p in (0.25, 0.5, 0.75))
    f = F.col("fare_amount")
    s = c.withColumn("stratum", F.when(f <= q1, 0).when(f <= q2, 1).when(f <= q3, 2).otherwise(3))
    frac = F.when(F.col("stratum") == 0, 100).when(F.col("stratum") == 1, 200).when(F.col("stratum") == 2, 300).otherwise(500)
    return s.where(pp.hash_bucket(buckets=1000) < frac).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))


@register("src_csv_roundtrip", v.with_views("""
SELECT count(*) AS n_rows, round(sum(fare_amount), 2) AS fare_sum, CAST(sum(passenger_count) AS BIGINT) AS passengers
FROM clean_trips""", "clean_trips"))
def _csv(spark, sf):
    """SRC-1/VAL-1..10: trips written in the raw CSV layout (odd header names, text times
    'yyyy-MM-dd HH:mm:ss UTC'), read back with a typed schema, then validated."""
    path = scratch_path(spark, "raw-csv")
    t = v.trips(spark, sf)
    raw = t.select(F.concat_ws("_", "event_type", F.col("event_id").cast("string")).alias("key"),
                   "fare_amount", F.col("pickup_datetime").cast("timestamp").alias("pickup_datetime"),
                   "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
                   F.col("passenger_count").cast("double").alias("passenger_count"),
                   F.col("event_id").alias("event_id"))
    files.write_trip_csv(raw.withColumnRenamed("fare_amount", " Fare Amount "), path)
    from pyspark.sql import types as T

    fields = [T.StructField(" Fare Amount " if f.name == "fare_amount" else f.name, f.dataType)
              for f in files.RAW_TRIP_SCHEMA.fields]
    schema = T.StructType(fields + [T.StructField("event_id", T.LongType())])
    back = files.read_trip_csv(spark, path, schema=schema)
    clean = val.validate_trips(back)
    return clean.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("fare_amount"), 2).alias("fare_sum"),
                     F.sum("passenger_count").cast("bigint").alias("passengers"))


@register("snk_drift_report", _psi_sql())
def _drift_report(spark, sf):
    """SNK-1/SRC-8: drift table written as one sorted CSV and read back with a checked schema."""
    f = v.features(spark, sf)
    is_exp = F.col("pickup_datetime") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    d = met.psi(f.withColumn("side", F.when(is_exp, "expected").otherwise("actual")), "side", PSI_COLS)
    path = scratch_path(spark, "drift-report")
    files.write_report_csv(d, path, [F.desc("drift_score"), "feature"])
    back = files.read_csv_checked(spark, path, "feature string, drift_score double", ["feature", "drift_score"])
    return back.select("feature", rnd("drift_score").alias("drift_score"))


MONITOR_SAMPLE = 1000


@register("snk_monitor_scores", v.with_views(SCORED_SQL + f"""
SELECT count(*) AS n_full, least(count(*), {MONITOR_SAMPLE}) AS n_sample,
  round(sum(abs(predicted_fare - actual_fare)), 4) AS abs_error, count(*) FILTER (WHERE pricing_flag = 'NORMAL') AS n_normal
FROM scored""", "features", "pairs"))
def _monitor_scores(spark, sf):
    """SNK-2: the whole monitor table to parquet, and a sample of a given size as CSV; both read back."""
    s = scored(spark, sf).select("event_id", "predicted_fare", "actual_fare",
                                 F.abs(F.col("predicted_fare") - F.col("actual_fare")).alias("abs_error"),
                                 "pricing_flag")
    base = scratch_path(spark, "monitor")
    s.write.mode("overwrite").parquet(f"{base}/full")
    full = spark.read.parquet(f"{base}/full")
    pp.sample_n(full, MONITOR_SAMPLE).write.mode("overwrite").option("header", True).csv(f"{base}/sample")
    n_sample = spark.read.option("header", True).csv(f"{base}/sample").count()
    return full.agg(F.count(F.lit(1)).alias("n_full"), F.lit(n_sample).cast("bigint").alias("n_sample"),
                    F.round(F.sum("abs_error"), 4).alias("abs_error"),
                    F.count_if(F.col("pricing_flag") == "NORMAL").alias("n_normal"))


_RUN = "'run-' || strftime(DATE '1970-01-01' + CAST({s} AS INTEGER), '%Y-%m-%d')"


@register("snk_promotion_log", _REPLAY_ORACLE + f"""
, g AS (SELECT *, champion_rmse IS NOT NULL AS has, (champion_rmse - rmse) / greatest(champion_rmse, 1e-9) AS rel FROM chain)
SELECT strftime(DATE '1970-01-01' + CAST(seq AS INTEGER), '%Y-%m-%d 00:00:00') AS evaluated_at, decision,
  {_RUN.format(s='seq')} AS challenger_name, round(rmse, 4) AS challenger_rmse,
  CASE WHEN has THEN {_RUN.format(s='champion_seq')} END AS champion_name, round(champion_rmse, 4) AS champion_rmse, round(champion_r2, 4) AS champion_r2,
  CASE WHEN has THEN rel >= 0.02 END AS rmse_improvement_passed, CASE WHEN has THEN r2 >= 0.80 END AS r2_floor_passed,
  CASE WHEN has THEN gap <= 0.15 END AS gap_passed
FROM g ORDER BY seq DESC LIMIT 1""")
def _promotion_log(spark, sf):
    """SNK-6 + SRC-9 + GAT-2: daily runs replayed, appended as JSON records with a nested
    gates struct, read back; latest record with its gates."""
    r = replay(spark, daily_runs(spark, sf)).withColumnRenamed("rmse", "challenger_rmse") \
        .withColumnRenamed("r2", "challenger_r2").withColumnRenamed("gap", "challenger_gap")
    day = lambda c: F.date_format(F.date_from_unix_date(F.col(c).cast("int")), "yyyy-MM-dd")
    g = mon.apply_gate(r)
    rec = g.select("decision", "reason", F.concat(day("seq"), F.lit(" 00:00:00")).alias("evaluated_at"),
                   F.concat(F.lit("run-"), day("seq")).alias("challenger_name"), F.round("challenger_rmse", 4).alias("challenger_rmse"),
                   F.round("challenger_r2", 4).alias("challenger_r2"), F.round("challenger_gap", 4).alias("challenger_gap"),
                   F.concat(F.lit("run-"), day("champion_seq")).alias("champion_name"),
                   F.round("champion_rmse", 4).alias("champion_rmse"), F.round("champion_r2", 4).alias("champion_r2"),
                   F.when(F.col("champion_rmse").isNotNull(),
                          F.struct("rmse_improvement_passed", "r2_floor_passed", "gap_passed")).alias("gates"))
    path = scratch_path(spark, "promotion-log")
    files.append_json(rec, path)
    log = files.read_promotion_log(spark, path)
    return mon.latest_decision(log).select("evaluated_at", "decision", "challenger_name", "challenger_rmse", "champion_name",
                                           "champion_rmse", "champion_r2", "gates.rmse_improvement_passed",
                                           "gates.r2_floor_passed", "gates.gap_passed")


@register("snk_model_card")
def _card(spark, sf):
    """SNK-5: nested model card of the trained linear model (split sizes, metrics, calibration, flag counts,
    cost, importances, top SHAP features, pipeline settings), appended as JSON and read back."""
    model, prep, f = fitted(spark, sf, "linear")
    vectors = prep.transform(f)
    s = written_table(prc.price_trips(model.transform(vectors).withColumnsRenamed(
        {"prediction": "predicted_fare", "fare_amount": "actual_fare"})).select(
        "split", "actual_fare", "predicted_fare", "pricing_flag"), "card-scores")
    sizes = s.groupBy().pivot("split", ["train", "calibration", "test"]).count()
    te = s.where(F.col("split") == "test")
    metrics = met.regression_metrics(te, n_features=len(prep.feature_order)).drop("n")
    _iso, c = md.calibrate(s.where(F.col("split") == "calibration"), label="actual_fare", prediction="predicted_fare")
    cal = spark.createDataFrame([(c.coverage, c.k, c.empirical_coverage)], "coverage double, k double, empirical_coverage double")
    flags = te.groupBy("pricing_flag").agg(F.count(F.lit(1)).alias("n"))
    importances = spark.createDataFrame(md.feature_importance(model.stages[-1], prep.feature_order), "feature string, importance double")
    shap = md.vector_shap(vectors.where(F.col("split") == "train").select("features"),
                          model.stages[-1].coefficients.toArray(), prep.feature_order)
    config = {"family": "linear", "ordinal": prep.ordinal, "skewed": prep.skewed, "other": prep.other, "binary": prep.binary,
              "scaled": prep.scaled}
    card = files.model_card(sizes, metrics, cal, flags, met.cost_evaluation(te), importances,
                            shap.orderBy(F.desc("mean_abs_shap"), "feature").limit(10), config, "linear", "v1")
    path = scratch_path(spark, "model-cards")
    files.append_json(card, path)
    back = spark.read.schema(card.schema).json(path)
    return back.select("model_name", "version", "dataset.train", "dataset.test", "metrics.rmse",
                       "calibration.k", "cost_evaluation.total_estimated_cost",
                       F.size(F.map_keys("pricing_flags")).alias("n_flags"),
                       F.size(F.map_keys("feature_importances")).alias("n_importances"),
                       F.size(F.map_keys("shap_top_features")).alias("n_shap"), "pipeline_config.family")


@register("snk_comparison_csv", v.with_views(RULES_SQL + "\nSELECT * FROM summary", "features"))
def _comparison(spark, sf):
    """SNK-3: comparison table written sorted by (test_rmse, -test_r2) as CSV and read back."""
    t = rule_summary(spark, sf)
    path = scratch_path(spark, "comparison")
    files.write_report_csv(t, path, ["test_rmse", F.desc("test_r2")])
    return spark.read.schema(t.schema).option("header", True).csv(path)
