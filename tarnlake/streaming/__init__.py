"""Structured Streaming sources, sinks and continuous upserts."""
