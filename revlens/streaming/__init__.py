"""Incremental ingest of raw review dumps with Structured Streaming."""
