"""Telemetry plans: relations, facts, metrics, checks and reports as SQL plans."""
