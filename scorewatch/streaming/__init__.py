"""Structured Streaming: scoring, sinks that can be replayed, live views."""
