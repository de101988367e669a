"""Incremental screening."""
