"""Training-data operators and their queries (nothing outside imports this)."""
