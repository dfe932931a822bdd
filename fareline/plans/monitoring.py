"""Queries for the promotion gate (GAT-*) and monitoring (MON-*).

The promotion history is derived from the data: one challenger run per
pickup day, scored on its hash-split test rows (SPL-1), with the gap
between its train and test R2 - so the replay grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import MAX_GAP, MIN_R2, MIN_RMSE_IMPROVEMENT
from ..functions.stats import hash_unit
from ..operators import metrics as met
from ..operators import monitor as mon
from . import register
from . import views as v
from .common import rnd
from .metrics import PSI_COLS, psi_cte
from .pricing import SCORED_SQL, scored

HASH_SQL = "('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), '42')), 1, 8))::BIGINT % 100"
_R2 = "1 - sum(pow(predicted_fare - actual_fare, 2)) / (var_pop(actual_fare) * count(*))"

def _r2_sql(cond: str) -> str:
    """MET-3 R2 over the rows where ``cond`` holds: SST = 0 gives 1 when SSE = 0, else 0."""
    sse = f"sum(pow(predicted_fare - actual_fare, 2)) FILTER (WHERE {cond})"
    sst = f"(var_pop(actual_fare) FILTER (WHERE {cond}) * count(*) FILTER (WHERE {cond}))"
    return f"(CASE WHEN {sst} = 0 THEN (CASE WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - {sse} / {sst} END)"


RUNS_SQL = f"""
, hp AS (SELECT p.*, CAST(date_diff('day', DATE '1970-01-01', CAST(c.pickup_datetime AS DATE)) AS BIGINT) AS seq, {HASH_SQL} < 80 AS is_train
         FROM pairs p JOIN clean_trips c USING (event_id)),
runs AS (
  SELECT seq,
    sqrt(avg(pow(predicted_fare - actual_fare, 2)) FILTER (WHERE NOT is_train)) AS rmse,
    {_r2_sql("NOT is_train")} AS r2,
    abs({_r2_sql("is_train")} - {_r2_sql("NOT is_train")}) AS gap
  FROM hp GROUP BY seq
)"""


def daily_runs(spark, sf):
    """One challenger run per pickup date (seq: days since 1970-01-01): test RMSE / R2 and |train R2 - test R2|."""
    c = v.clean_trips(spark, sf)
    p = c.select("event_id", F.unix_date(F.to_date("pickup_datetime")).cast("bigint").alias("seq"),
                 (hash_unit("event_id") % 100 < 80).alias("is_train"),
                 F.col("fare_amount").alias("actual_fare"),
                 (F.col("fare_amount") * (75 + (F.col("event_id") * 13) % 51) / F.lit(1e2)).alias("predicted_fare"))
    m = met.regression_metrics(p, by=["seq", "is_train"])
    w = m.groupBy("seq").pivot("is_train", [True, False]).agg(F.first("rmse").alias("rmse"), F.first("r2").alias("r2"))
    return w.select("seq", F.col("false_rmse").alias("rmse"), F.col("false_r2").alias("r2"),
                    F.abs(F.col("true_r2") - F.col("false_r2")).alias("gap"))


REPLAY_SQL = """
WITH RECURSIVE ordered AS (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM {runs}),
chain AS (
  SELECT rn, seq, rmse, r2, gap, CAST(NULL AS DOUBLE) AS champion_rmse, CAST(NULL AS DOUBLE) AS champion_r2,
    CAST(NULL AS BIGINT) AS champion_seq, 'PROMOTED' AS decision, rmse AS next_champion, r2 AS next_r2, seq AS next_seq
  FROM ordered WHERE rn = 1
  UNION ALL
  SELECT r.rn, r.seq, r.rmse, r.r2, r.gap, c.next_champion AS champion_rmse, c.next_r2 AS champion_r2, c.next_seq AS champion_seq,
    CASE WHEN (c.next_champion - r.rmse) / greatest(c.next_champion, 1e-9) >= 0.02 AND r.r2 >= 0.80 AND r.gap <= 0.15
         THEN 'PROMOTED' ELSE 'REJECTED' END AS decision,
    CASE WHEN (c.next_champion - r.rmse) / greatest(c.next_champion, 1e-9) >= 0.02 AND r.r2 >= 0.80 AND r.gap <= 0.15
         THEN r.rmse ELSE c.next_champion END AS next_champion,
    CASE WHEN (c.next_champion - r.rmse) / greatest(c.next_champion, 1e-9) >= 0.02 AND r.r2 >= 0.80 AND r.gap <= 0.15 THEN r.r2 ELSE c.next_r2 END AS next_r2,
    CASE WHEN (c.next_champion - r.rmse) / greatest(c.next_champion, 1e-9) >= 0.02 AND r.r2 >= 0.80 AND r.gap <= 0.15 THEN r.seq ELSE c.next_seq END AS next_seq
  FROM chain c JOIN ordered r ON r.rn = c.rn + 1
)"""


def replay(spark, runs):
    """GAT-3: sequential champion replay over the run history.

    The champion only changes on a promotion, and the run promoted after
    champion ``j`` is the first later run that passes the gates against
    ``j``'s RMSE. So the chain of promotions is found with one ``min_by``
    aggregate over the (distributed) run table per promotion - the number of
    steps is the number of promotions, not of runs (a run-by-run recursive
    CTE stops at Spark's recursion limit of 100 levels). Every run then takes
    its champion from the chain interval it falls in: a range join in which
    each run matches exactly one interval (seq in (promoted_m, promoted_m+1]).
    A promotion lowers the RMSE by 2 % at least, so there are at most
    log(first / last) / -log(0.98) of them: the interval table is always small."""
    # the history is one row per run: cut its lineage once (reliable checkpoint
    # in spark.checkpoint.dir) so the steps do not recompute the trip scan
    runs = runs.select("seq", "rmse", "r2", "gap").checkpoint(eager=True)
    first = runs.orderBy("seq").limit(1).collect()
    chain = [(first[0]["seq"], first[0]["rmse"], first[0]["r2"])] if first else []
    gates = (F.col("r2") >= MIN_R2) & (F.col("gap") <= MAX_GAP)
    while chain:
        seq, champ, _ = chain[-1]
        rel = (F.lit(champ) - F.col("rmse")) / F.greatest(F.lit(champ), F.lit(1e-9))
        nxt = (runs.where((F.col("seq") > seq) & (rel >= MIN_RMSE_IMPROVEMENT) & gates)
               .agg(F.min_by(F.struct("seq", "rmse", "r2"), "seq").alias("n")).first()["n"])
        if nxt is None:
            break
        chain.append((nxt["seq"], nxt["rmse"], nxt["r2"]))
    bounds = [(s, chain[i + 1][0] if i + 1 < len(chain) else None, rmse, r2, s) for i, (s, rmse, r2) in enumerate(chain)]
    iv = F.broadcast(spark.createDataFrame(
        bounds, "_lo bigint, _hi bigint, champion_rmse double, champion_r2 double, champion_seq bigint"))
    inside = (F.col("seq") > F.col("_lo")) & (F.col("_hi").isNull() | (F.col("seq") <= F.col("_hi")))
    first_seq = chain[0][0] if chain else None
    promoted = (F.col("seq") == F.lit(first_seq)) | (F.col("seq") == F.col("_hi"))
    return (runs.join(iv, inside, "left")
            .select("seq", "rmse", "r2", "gap", "champion_rmse", "champion_r2", "champion_seq",
                    F.when(promoted, F.lit("PROMOTED")).otherwise(F.lit("REJECTED")).alias("decision")))


_REPLAY_ORACLE = v.with_views(RUNS_SQL, "pairs", "clean_trips")
_REPLAY_ORACLE = _REPLAY_ORACLE.replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + \
    REPLAY_SQL.format(runs="runs").replace("WITH RECURSIVE ", "", 1).strip()


@register("gat_replay", _REPLAY_ORACLE + """
SELECT seq, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(gap, 6) AS gap, round(champion_rmse, 6) AS champion_rmse, decision FROM chain""")
def _gat_replay(spark, sf):
    """GAT-3: which daily challenger run would have been promoted, in order."""
    r = replay(spark, daily_runs(spark, sf))
    return r.select("seq", rnd("rmse").alias("rmse"), rnd("r2").alias("r2"), rnd("gap").alias("gap"),
                    rnd("champion_rmse").alias("champion_rmse"), "decision")


@register("gat_latest", _REPLAY_ORACLE + """
SELECT seq, decision, round(champion_rmse, 6) AS champion_rmse FROM chain ORDER BY seq DESC LIMIT 1""")
def _gat_latest(spark, sf):
    """GAT-2: the latest decision of the history (top-1)."""
    r = replay(spark, daily_runs(spark, sf))
    return mon.latest_decision(r, "seq").select("seq", "decision", rnd("champion_rmse").alias("champion_rmse"))


_GATE_SQL = v.with_views(RUNS_SQL + """
, two AS (SELECT CASE WHEN 2 * seq <= (SELECT min(seq) + max(seq) FROM hp) THEN 'champion' ELSE 'challenger' END AS role, * FROM hp),
m AS (SELECT role,
    sqrt(avg(pow(predicted_fare - actual_fare, 2)) FILTER (WHERE NOT is_train)) AS rmse,
    1 - sum(pow(predicted_fare - actual_fare, 2)) FILTER (WHERE NOT is_train)
      / (var_pop(actual_fare) FILTER (WHERE NOT is_train) * count(*) FILTER (WHERE NOT is_train)) AS r2,
    1 - sum(pow(predicted_fare - actual_fare, 2)) FILTER (WHERE is_train)
      / (var_pop(actual_fare) FILTER (WHERE is_train) * count(*) FILTER (WHERE is_train)) AS r2_train
  FROM two GROUP BY role),
g AS (SELECT c.rmse AS challenger_rmse, c.r2 AS challenger_r2, abs(c.r2_train - c.r2) AS challenger_gap, h.rmse AS champion_rmse,
        (h.rmse - c.rmse) / greatest(h.rmse, 1e-9) AS rel
      FROM m c, m h WHERE c.role = 'challenger' AND h.role = 'champion')
SELECT round(challenger_rmse, 6) AS challenger_rmse, round(challenger_r2, 6) AS challenger_r2,
  round(challenger_gap, 6) AS challenger_gap, round(champion_rmse, 6) AS champion_rmse,
  rel >= 0.02 AS rmse_improvement_passed, challenger_r2 >= 0.80 AS r2_floor_passed, challenger_gap <= 0.15 AS gap_passed,
  CASE WHEN rel >= 0.02 AND challenger_r2 >= 0.80 AND challenger_gap <= 0.15 THEN 'PROMOTED' ELSE 'REJECTED' END AS decision
FROM g""", "pairs", "clean_trips")


@register("gat_decision", _GATE_SQL)
def _gat_decision(spark, sf):
    """GAT-1: the gate for the second half of the dates (challenger) against the first (champion)."""
    c = v.clean_trips(spark, sf)
    seq = F.unix_date(F.to_date("pickup_datetime"))
    ends = c.agg(F.min(seq), F.max(seq)).first()
    p = c.select(F.when(2 * seq <= sum(x or 0 for x in ends), "champion").otherwise("challenger").alias("role"),
                 (hash_unit("event_id") % 100 < 80).alias("is_train"), F.col("fare_amount").alias("actual_fare"),
                 (F.col("fare_amount") * (75 + (F.col("event_id") * 13) % 51) / F.lit(1e2)).alias("predicted_fare"))
    m = met.regression_metrics(p, by=["role", "is_train"])
    w = m.groupBy(F.lit(1).alias("_k")).pivot("role", ["champion", "challenger"]).agg(
        F.first(F.when(~F.col("is_train"), F.col("rmse")), ignorenulls=True).alias("rmse"),
        F.first(F.when(~F.col("is_train"), F.col("r2")), ignorenulls=True).alias("r2"),
        F.first(F.when(F.col("is_train"), F.col("r2")), ignorenulls=True).alias("r2_train"))
    g = w.select(F.col("challenger_rmse"), F.col("challenger_r2"),
                 F.abs(F.col("challenger_r2_train") - F.col("challenger_r2")).alias("challenger_gap"),
                 F.col("champion_rmse"))
    g = mon.apply_gate(g)
    return g.select(*[rnd(c).alias(c) for c in ("challenger_rmse", "challenger_r2", "challenger_gap", "champion_rmse")],
                    "rmse_improvement_passed", "r2_floor_passed", "gap_passed", "decision")


_REASON_SQL = _REPLAY_ORACLE + """
, g AS (SELECT seq, rmse, r2, gap, champion_rmse, (champion_rmse - rmse) / greatest(champion_rmse, 1e-9) AS rel,
          (champion_rmse - rmse) / greatest(champion_rmse, 1e-9) >= 0.02 AS g1, r2 >= 0.80 AS g2, gap <= 0.15 AS g3
        FROM chain)
SELECT seq,
  CASE WHEN champion_rmse IS NULL OR (g1 AND g2 AND g3) THEN 'PROMOTED' ELSE 'REJECTED' END AS decision,
  CASE WHEN champion_rmse IS NULL THEN 'No existing champion — first model auto-promoted'
       WHEN g1 AND g2 AND g3 THEN printf('Challenger beats champion: RMSE %.4f → %.4f (%+.2f%%)', champion_rmse, rmse, rel * 100)
       ELSE 'Gates failed: ' || concat_ws(' | ',
         CASE WHEN NOT g1 THEN printf('RMSE improvement %+.2f%% < %.1f%%', rel * 100, 2.0) END,
         CASE WHEN NOT g2 THEN printf('R2 %.4f < %s', r2, '0.8') END,
         CASE WHEN NOT g3 THEN printf('train-test R2 gap %.4f > %s', gap, '0.15') END) END AS reason
FROM g"""


@register("gat_reason", _REASON_SQL)
def _gat_reason(spark, sf):
    """GAT-1 reason text for every daily run against its replayed champion."""
    r = replay(spark, daily_runs(spark, sf)).withColumnRenamed("rmse", "challenger_rmse") \
        .withColumnRenamed("r2", "challenger_r2").withColumnRenamed("gap", "challenger_gap")
    return mon.apply_gate(r).select("seq", "decision", "reason")


MON_SQL = SCORED_SQL + """
, k AS (SELECT count(*) AS n, avg(actual_fare) AS avg_actual_fare, avg(predicted_fare) AS avg_predicted_fare,
          avg(abs(predicted_fare - actual_fare)) AS avg_abs_error,
          avg(abs(predicted_fare - actual_fare) / greatest(actual_fare, 1e-6)) AS mape,
          avg(CAST(pricing_flag = 'SURGE_ELIGIBLE' AS DOUBLE)) AS surge_rate FROM scored)"""


@register("mon_kpis", v.with_views(MON_SQL + """
SELECT n, round(avg_actual_fare, 6) AS avg_actual_fare, round(avg_predicted_fare, 6) AS avg_predicted_fare,
  round(avg_abs_error, 6) AS avg_abs_error, round(mape, 6) AS mape, round(surge_rate, 6) AS surge_rate FROM k""",
                                   "features", "pairs"))
def _mon_kpis(spark, sf):
    """MON-4 (+ MON-1/MON-2 inputs): KPI tiles of the scored trips."""
    k = mon.monitor_kpis(scored(spark, sf))
    return k.select("n", *[rnd(c).alias(c) for c in ("avg_actual_fare", "avg_predicted_fare", "avg_abs_error",
                                                     "mape", "surge_rate")])


def _alerts_sql(mape_alert=0.25, surge_alert=0.30):
    return v.with_views(MON_SQL + ",\n" + psi_cte() + f"""
, d AS (SELECT max(drift_score) AS m, arg_max(feature, drift_score) AS top FROM res),
fired AS (
  SELECT 'error' AS level, 'HIGH_MAPE' AS alert, mape AS value, CAST(NULL AS VARCHAR) AS detail FROM k WHERE mape > {mape_alert}
  UNION ALL SELECT 'warning', 'HIGH_SURGE_RATE', surge_rate, NULL FROM k WHERE surge_rate > {surge_alert}
  UNION ALL SELECT CASE WHEN m >= 0.20 THEN 'error' ELSE 'warning' END, CASE WHEN m >= 0.20 THEN 'CRITICAL_DRIFT' ELSE 'MODERATE_DRIFT' END, m, top
    FROM d WHERE m >= 0.10)
SELECT level, alert, round(value, 6) AS value, detail FROM fired
UNION ALL SELECT 'ok', 'ALL_NORMAL', NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM fired)""", "features", "pairs")


def _alerts(spark, sf, mape_alert=0.25, surge_alert=0.30):
    f = v.features(spark, sf)
    is_exp = F.col("pickup_datetime") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    drift = met.psi(f.withColumn("side", F.when(is_exp, "expected").otherwise("actual")), "side", PSI_COLS)
    a = mon.alert_rows(mon.monitor_kpis(scored(spark, sf)), drift, mape_alert=mape_alert, surge_alert=surge_alert)
    return a.withColumn("value", rnd("value"))


@register("mon_alerts", _alerts_sql())
def _mon_alerts(spark, sf):
    """MON-1/2/3/5: MAPE > 0.25, surge rate > 0.30, PSI drift; 'ALL_NORMAL' when none fired."""
    return _alerts(spark, sf)


@register("mon_alerts_strict", _alerts_sql(0.10, 0.05))
def _mon_alerts_strict(spark, sf):
    """MON-1/2/5 with tight thresholds (10% MAPE, 5% surge), so the alert rows fire."""
    return _alerts(spark, sf, 0.10, 0.05)


@register("mon_recent", v.with_views(SCORED_SQL + """
, r AS (SELECT s.event_id, c.pickup_datetime, s.predicted_fare, s.pricing_flag FROM scored s JOIN clean_trips c USING (event_id))
SELECT event_id, epoch_us(pickup_datetime) AS pickup_us, round(predicted_fare, 6) AS predicted_fare, pricing_flag
FROM r ORDER BY pickup_datetime DESC, event_id DESC LIMIT 20""", "features", "pairs", "clean_trips"))
def _mon_recent(spark, sf):
    """MON-6: the 20 most recent scored trips (top-k, no global sort)."""
    s = scored(spark, sf)
    top = s.orderBy(F.desc("pickup_datetime"), F.desc("event_id")).limit(20)
    return top.select("event_id", F.unix_micros(F.col("pickup_datetime").cast("timestamp")).alias("pickup_us"),
                      rnd("predicted_fare").alias("predicted_fare"), "pricing_flag")


@register("mon_sample", v.with_views(SCORED_SQL + f"""
SELECT event_id, round(actual_fare, 6) AS actual_fare, round(predicted_fare, 6) AS predicted_fare
FROM scored ORDER BY ('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), '42')), 1, 8))::BIGINT, event_id LIMIT 500""",
                                     "features", "pairs"))
def _mon_sample(spark, sf):
    """MON-7 / SRC-5: a reproducible 500-trip sample (hash order top-k) for the scatter."""
    s = scored(spark, sf)
    return s.orderBy(hash_unit("event_id"), "event_id").limit(500).select(
        "event_id", rnd("actual_fare").alias("actual_fare"), rnd("predicted_fare").alias("predicted_fare"))
