"""PRF-8: the binned kernel density against direct summation; ST-2 sessions over a restarted stream."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.operators import profile as prf
from fareline.plans.arrivals import feed_in_slices
from fareline.streaming import jobs


def test_density_against_direct_summation(spark):
    rng = random.Random(8)
    data = {"a": [rng.gauss(20, 6) for _ in range(900)], "b": [rng.choice([10.0, 10.0, 52.0]) + rng.expovariate(0.2) for _ in range(500)]}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), ("b", float("nan")), ("same", 5.0), ("same", 5.0), ("one", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = prf.kernel_density(df, "v", 0.0, 100.0, by=["g"]).orderBy("g", "point").collect()
    assert {r["g"] for r in got} == {"a", "b"}
    for g, vs in data.items():
        mine = [r for r in got if r["g"] == g]
        assert [r["point"] for r in mine] == list(range(512))
        x, v = np.array([r["x"] for r in mine]), np.clip(vs, 0, 100)
        bw = v.std(ddof=1) * len(v) ** -0.2
        want = np.exp(-0.5 * ((x[:, None] - v) / bw) ** 2).sum(axis=1) / (len(v) * bw * np.sqrt(2 * np.pi))
        assert np.abs(np.array([r["density"] for r in mine]) - want).max() < 1e-3 * want.max()
    assert prf.kernel_density(df.limit(0), "v", 0.0, 100.0).count() == 0


def test_sessions_across_restarts(spark, tmp_path):
    """Every slice runs the query anew from its checkpoint: sessions that span slices stay whole, late rows are dropped."""
    begin = dt.datetime(2024, 1, 1)
    rng, rows = random.Random(1), []
    for key in (1, 2):
        t = 0
        for _ in range(60):
            t += rng.choice([1, 3, 9, 15, 40])
            rows.append((key, begin + dt.timedelta(minutes=t), 1.0, 2.0))
    df = spark.createDataFrame(rows, "k int, at timestamp, predicted_fare double, actual_fare double")
    late = df.where(F.col("at") < F.lit(begin + dt.timedelta(minutes=20)))
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))

    def run():
        stream = jobs.read_stream(spark, src, df.schema).withColumn("event_time", F.col("at"))
        jobs.run_available_now(jobs.session_kpis(stream, ["k"]), sink, ckpt)

    feed_in_slices(df, "at", 4, src, run, late)
    got = {(r["k"], r["session_start"], r["session_end"], r["n"]) for r in spark.read.parquet(sink).collect()}
    gap, want, last = dt.timedelta(minutes=10), set(), max(r[1] for r in rows)
    for key in (1, 2):
        times = sorted(r[1] for r in rows if r[0] == key)
        start = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] - times[i - 1] >= gap:
                if times[i - 1] + gap <= last - gap:
                    want.add((key, times[start], times[i - 1] + gap, i - start))
                start = i
    assert got == want and len(want) > 20
    assert spark.read.parquet(sink).agg(F.sum("predicted")).first()[0] == pytest.approx(sum(n for *_, n in want))
