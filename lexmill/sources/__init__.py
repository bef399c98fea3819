"""Readers and writers that Spark does not ship."""
