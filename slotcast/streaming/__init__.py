"""Structured Streaming forms of the ingest steps."""
