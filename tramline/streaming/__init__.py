"""Structured Streaming readers and writers."""
