"""Incremental loading of fragments as they arrive."""
