"""SparkSession settings shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on: UTC wall clock (timestamps are read as
# UTC, zone conversion is explicit), ANSI arithmetic (divisions use
# try_divide where the reference yields inf/NaN) and adaptive execution so
# shuffle partition counts and skewed joins are re-planned at run time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # aggregates over many column pairs (correlations, likelihood grids) stay in generated code
    "spark.sql.codegen.maxFields": "1000",
    # streaming state off the JVM heap (windowed KPIs, replay dedup)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fareline") -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[N]``. The shuffle partition count is only forced when asked:
    on a cluster it should be sized to the data (AQE coalesces anyway).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    for k, v in SESSION_CONF.items():
        if k in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            continue  # static, cannot change on a running session
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on a shared session
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; we only create a local one when it is unset
    (tests on a laptop). Lineage is cut with ``checkpoint()`` or written
    tables under this folder, never with ``localCheckpoint``.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder (all executors and the "
                               "driver must see it) before running on a cluster")
        path = tempfile.mkdtemp(prefix="fareline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    return os.path.join(base, f"fareline-{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of this library, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
