"""Whole runs: merge, screen, watch."""
