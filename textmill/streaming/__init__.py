"""Structured Streaming entry points (incremental ingest)."""
