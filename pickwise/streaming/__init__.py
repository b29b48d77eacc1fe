"""Structured Streaming operators over the events stream."""
