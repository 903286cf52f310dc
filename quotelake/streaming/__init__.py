"""Structured Streaming versions of the tick pipeline."""
