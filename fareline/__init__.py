"""Spark-native trip-pricing analytics: DataFrame operators for ingest, validation, features, profiling, models, pricing and monitoring."""

__version__ = "0.1.0"
