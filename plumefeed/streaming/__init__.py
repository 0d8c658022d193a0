"""Structured Streaming forms of the clean and index jobs."""
