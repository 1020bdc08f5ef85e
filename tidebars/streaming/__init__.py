"""Structured Streaming form of the daily increment."""
