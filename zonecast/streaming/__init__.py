"""Structured Streaming jobs over the same tables."""
