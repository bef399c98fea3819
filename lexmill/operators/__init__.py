"""Relational operators: filters, line dedup, near-dup, scoring, statistics."""
