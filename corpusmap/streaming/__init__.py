"""Structured Streaming jobs over article change events."""
