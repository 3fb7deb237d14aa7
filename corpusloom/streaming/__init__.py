"""Incremental ingestion with Structured Streaming (ST1)."""
