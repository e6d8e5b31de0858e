"""Telemetry sources on DataFrames."""
