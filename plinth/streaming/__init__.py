"""Structured Streaming extensions (not part of the batch feature set)."""
