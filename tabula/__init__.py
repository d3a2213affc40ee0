"""Spark-native tabular analytics: ingest, cleaning, profiling, reports, features, models, metrics."""
