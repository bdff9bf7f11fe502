"""Incremental loading of newly arrived files."""
