"""Fixtures derived from the provided tables, and the registry of queries."""
