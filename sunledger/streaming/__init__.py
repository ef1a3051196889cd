"""Continuous ingest of logger lines."""
