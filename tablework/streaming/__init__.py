"""Incremental loading of new files."""
