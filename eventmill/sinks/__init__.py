"""Sinks: flat table, document table, dead letters, topic rows, snapshots."""
