"""Readers, crawlers and writers."""
