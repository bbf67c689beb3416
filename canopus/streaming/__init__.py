"""Incremental ingest of tag-line files with Structured Streaming."""
