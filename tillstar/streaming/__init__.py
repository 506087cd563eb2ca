"""Incremental (Structured Streaming) form of the raw-table load."""
