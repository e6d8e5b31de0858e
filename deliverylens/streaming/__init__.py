"""Telemetry streaming on DataFrames."""
