"""Anomaly analytics for device telemetry on Spark."""
