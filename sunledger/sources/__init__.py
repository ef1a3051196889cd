"""Readers for raw series, weather and battery documents; export."""
