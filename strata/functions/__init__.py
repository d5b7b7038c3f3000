"""Column-level building blocks (pure Spark expressions, no Python UDFs)."""
