"""Structured Streaming forms of the operators (runner, top-N, patterns, refresh, upsert)."""
