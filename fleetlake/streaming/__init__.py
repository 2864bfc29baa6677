"""Structured Streaming versions of ingest and the daily summary."""
