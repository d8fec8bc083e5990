"""Structured Streaming forms of ingestion, monitoring and extraction."""
