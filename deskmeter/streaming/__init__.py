"""Incremental forms of the daily run."""
