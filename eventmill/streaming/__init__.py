"""Structured Streaming ingest: sources, stateful dedup, foreachBatch sinks, rollup partials."""
