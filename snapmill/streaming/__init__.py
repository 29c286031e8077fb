"""Incremental ingestion of landed files with Structured Streaming."""
