"""Structured Streaming variants of the incremental ingest."""
