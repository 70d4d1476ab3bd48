"""Lakehouse analytics for retail-bank data, written as plain PySpark jobs."""
