"""Incremental processing with Structured Streaming (resumable runs)."""
