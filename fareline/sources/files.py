"""File sources and sinks (SRC-1, SRC-8, SRC-9, SNK-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw trip CSV layout: key, fare, pickup time text 'yyyy-MM-dd HH:mm:ss UTC', 4 coordinates, passengers.
RAW_TRIP_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("pickup_datetime", T.TimestampType()),
    T.StructField("pickup_longitude", T.DoubleType()),
    T.StructField("pickup_latitude", T.DoubleType()),
    T.StructField("dropoff_longitude", T.DoubleType()),
    T.StructField("dropoff_latitude", T.DoubleType()),
    T.StructField("passenger_count", T.DoubleType()),
])
RAW_TS_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"


def read_trip_csv(spark: SparkSession, path: str, *, schema=RAW_TRIP_SCHEMA, mode: str = "PERMISSIVE",
                  ts_format: str = RAW_TS_FORMAT) -> DataFrame:
    """SRC-1: typed CSV scan (explicit schema, no inference); ``mode='FAILFAST'``
    raises on a malformed number as pandas does, PERMISSIVE gives NULL."""
    return (spark.read.schema(schema).option("header", True).option("timestampFormat", ts_format)
            .option("mode", mode).csv(path))


def write_trip_csv(df: DataFrame, path: str, ts_format: str = RAW_TS_FORMAT) -> None:
    (df.write.mode("overwrite").option("header", True).option("timestampFormat", ts_format).csv(path))


def first_n(df: DataFrame, n: int, order_by) -> DataFrame:
    """SRC-2: first N rows in an explicit order (top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def read_csv_checked(spark: SparkSession, path: str, schema, required) -> DataFrame:
    """SRC-8: read a report CSV with a schema and check the required columns."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df


GATES = T.StructType([T.StructField("rmse_improvement_passed", T.BooleanType()),
                      T.StructField("r2_floor_passed", T.BooleanType()),
                      T.StructField("gap_passed", T.BooleanType())])
PROMOTION_SCHEMA = T.StructType([
    T.StructField("decision", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("evaluated_at", T.StringType()), T.StructField("challenger_name", T.StringType()),
    T.StructField("challenger_rmse", T.DoubleType()), T.StructField("challenger_r2", T.DoubleType()),
    T.StructField("challenger_gap", T.DoubleType()), T.StructField("champion_name", T.StringType()),
    T.StructField("champion_rmse", T.DoubleType()), T.StructField("champion_r2", T.DoubleType()),
    T.StructField("gates", GATES),
])


def read_promotion_log(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """SRC-9: promotion history (JSON records; absent fields -> NULL)."""
    return spark.read.schema(PROMOTION_SCHEMA).option("multiLine", multiline).json(path)


def append_json(df: DataFrame, path: str) -> None:
    """SNK-5/SNK-6: append records (new files, no read-modify-write race)."""
    df.write.mode("append").json(path)


def write_report_csv(df: DataFrame, path: str, order_by) -> None:
    """SNK-1/SNK-3: a small sorted report as one CSV file with header."""
    df.orderBy(*order_by).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def model_card(split_sizes: DataFrame, metrics: DataFrame, calibration: DataFrame, flags: DataFrame,
               cost: DataFrame, importances: DataFrame, shap: DataFrame, config: dict, name: str, version: str) -> DataFrame:
    """SNK-5: one nested run record assembled from one-row aggregates and small maps; metrics rounded to 4.

    ``importances`` and ``shap`` are (feature, value) tables with a row per feature; ``config`` are the
    fitted pipeline's settings (strings and lists of strings)."""
    def as_map(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
        return df.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value)))).alias(out))

    def as_struct(df: DataFrame, out: str, digits: int | None = None) -> DataFrame:
        cols = [F.round(c, digits).alias(c) if digits is not None and t == "double" else F.col(c) for c, t in df.dtypes]
        return df.select(F.struct(*cols).alias(out))

    parts = [as_struct(split_sizes, "dataset"), as_struct(metrics, "metrics", 4), as_struct(calibration, "calibration", 4),
             as_map(flags, "pricing_flag", "n", "pricing_flags"), as_struct(cost, "cost_evaluation"),
             as_map(importances, "feature", "importance", "feature_importances"),
             as_map(shap, "feature", "mean_abs_shap", "shap_top_features")]
    card = parts[0]
    for p in parts[1:]:
        card = card.crossJoin(F.broadcast(p))       # one row each
    entries = [F.array(*map(F.lit, v)).cast("array<string>").alias(k) if isinstance(v, list) else F.lit(str(v)).alias(k)
               for k, v in config.items()]
    return card.select(F.lit(name).alias("model_name"), F.lit(version).alias("version"), *card.columns,
                       F.struct(*entries).alias("pipeline_config"))
