"""Structured Streaming ingestion of landing folders into raw tables."""
