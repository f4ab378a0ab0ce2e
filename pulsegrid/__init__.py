"""Telemetry analytics on Spark: ingest, rollups, seasonal-trend models, anomaly detection."""
