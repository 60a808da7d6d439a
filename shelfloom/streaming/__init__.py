"""Structured Streaming forms of the parsing stages."""
