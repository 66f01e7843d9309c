"""Readers for files, databases and tables."""
