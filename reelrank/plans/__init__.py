"""Composed recommenders, the registry of named queries, their oracles."""
