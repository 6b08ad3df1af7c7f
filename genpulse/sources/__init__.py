"""Readers, writers and guards of telemetry tables."""
