"""Readers, the table registry, dated JSON extraction and repeatable test data."""
