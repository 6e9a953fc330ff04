"""Readers and writers: parquet, JSON lines, CSV and versioned tables."""
