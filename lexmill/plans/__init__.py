"""Whole curation plans composed of the operators."""
