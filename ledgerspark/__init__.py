"""Spark-native jobs for LLM-usage and engineering telemetry."""
