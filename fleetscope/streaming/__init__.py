"""Structured Streaming queries of the live board."""
