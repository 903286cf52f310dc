"""Scans, sinks and the CSV → Parquet conversion."""
