"""Incremental form of the curation plan."""
