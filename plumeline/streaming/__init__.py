"""Incremental steps on Structured Streaming."""
