"""Reusable table operators: latest row per key, upsert, data checks."""
