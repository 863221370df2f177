"""Batch analytics for trip records, written as plain PySpark DataFrame jobs."""
