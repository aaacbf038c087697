"""Structured Streaming: package publishing and push feeds."""
