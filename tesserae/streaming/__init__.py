"""Structured Streaming forms of stateless and stream-static operators."""
