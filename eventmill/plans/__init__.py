"""Query registry (name -> Spark query), DuckDB oracle SQL, and plan checks."""
