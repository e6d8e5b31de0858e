"""Telemetry functions on DataFrames."""
