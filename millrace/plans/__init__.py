"""Composite jobs: calendars, dimensions, facts, cleaning jobs and reports."""
