"""Spark-native scorecard warehouse: ingest, clean, resolve, load, model, marts, audit."""
