"""Reusable DataFrame operators (keys, lookups, sinks, quality checks)."""
