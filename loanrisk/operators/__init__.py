"""Reusable table operators: keys and dedup, skew-safe joins, history, append, quality checks."""
