"""Operators: DataFrame -> DataFrame transformations (validation, enrichment, dedup,
rollups, analytics, lookups, windows, metrics, layout)."""
