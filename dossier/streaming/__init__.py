"""Structured Streaming forms of routing and collapse."""
