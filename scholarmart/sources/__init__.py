"""Scans, inline tables, series, watermarks and sinks."""
