"""Structured Streaming ingestion, progress metrics and run log."""
