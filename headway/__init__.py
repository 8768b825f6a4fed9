"""Headway: a Spark-native engine for fleet telemetry, built on DataFrames, Spark SQL and Structured Streaming."""
