"""Millrace: warehouse building and table analytics written as PySpark DataFrames."""

__version__ = "0.1.0"
