"""Structured Streaming ingest and batch stamping."""
