"""Column-level functions (JVM-side expressions, no Python UDFs)."""
