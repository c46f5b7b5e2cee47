"""Structured Streaming forms of the batch operators (no new operators)."""
