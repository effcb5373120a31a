"""Structured Streaming forms of the telemetry, alert and log operators."""
