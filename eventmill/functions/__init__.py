"""Column functions: pure expressions over columns, all JVM-side (no Python UDFs)."""
