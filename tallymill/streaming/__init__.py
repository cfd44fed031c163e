"""Structured Streaming ingestion of dropped CSV files."""
