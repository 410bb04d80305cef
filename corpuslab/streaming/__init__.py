"""Incremental forms of ingest, task push and scoring on Structured Streaming."""
