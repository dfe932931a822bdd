"""SNK-4: the committing sink keeps each row once, whatever is replayed."""

import glob
import json
import os

from pyspark.sql import functions as F

from fareline.sources import prediction_log as log
from fareline.streaming import jobs

SCHEMA = "id long, fare double, band string"


def test_replayed_and_failed_batches_leave_no_repeated_row(spark, tmp_path):
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "log", "ckpt"))
    rows = spark.range(40).select("id", (F.col("id") * 1.5).alias("fare"), F.lit("Short \"x\",é").alias("band"))
    for part in range(3):
        rows.where(F.col("id") % 3 == part).repartition(2).write.mode("append").parquet(src)
        log.write_prediction_log(jobs.read_stream(spark, src, rows.schema), path, ckpt)
    want = [tuple(r) for r in rows.orderBy("id").collect()]
    have = lambda: [tuple(r) for r in log.read_prediction_log(spark, path, SCHEMA).orderBy("id").collect()]
    assert have() == want
    # the driver died after the log's commit and before the query's own: the last batch runs again
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{ckpt}/commits/*"))
    for name in (f"{ckpt}/commits/{last}", f"{ckpt}/commits/.{last}.crc"):
        if os.path.exists(name):
            os.remove(name)
    n_parts = len(glob.glob(f"{path}/parts/*"))
    log.write_prediction_log(jobs.read_stream(spark, src, rows.schema), path, ckpt)
    assert have() == want and len(glob.glob(f"{path}/parts/*")) == n_parts
    # a batch that never came to its commit
    writer = log.PredictionLogWriter(path)
    lost = writer.write(iter(rows.limit(3).collect()))
    assert lost.rows == 3 and have() == want
    writer.abort([lost, None], 99)
    assert len(glob.glob(f"{path}/parts/*")) == n_parts
    # the same batch id once more
    again = writer.write(iter(rows.limit(5).collect()))
    writer.commit([again], 0)
    assert have() == want
    assert [json.load(open(p))["batch_id"] for p in sorted(glob.glob(f"{path}/_commits/0*"))] == list(range(last + 1))


def test_empty_log(spark, tmp_path):
    writer = log.PredictionLogWriter(str(tmp_path / "log"))
    writer.commit([writer.write(iter(())), None], 0)
    assert log.read_prediction_log(spark, str(tmp_path / "log"), SCHEMA).count() == 0
