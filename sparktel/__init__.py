"""Observability telemetry analytics on Spark."""
