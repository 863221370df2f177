"""Incremental file-source variant of the month load."""
