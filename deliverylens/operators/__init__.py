"""Telemetry operators on DataFrames."""
