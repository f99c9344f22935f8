"""Layered telemetry processing on Spark: conform, load by day, enrich, aggregate."""
