"""Registered queries: each pairs a Spark query with a checking query for the same tables."""
