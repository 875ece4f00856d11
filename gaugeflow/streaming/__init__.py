"""Structured Streaming jobs, each with its own checkpoint."""
