"""Incremental versions of ingest, merge, preference learning and the quality gate."""
