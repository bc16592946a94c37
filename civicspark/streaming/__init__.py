"""Structured Streaming over the landed files."""
