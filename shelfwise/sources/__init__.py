"""Readers, writers, page extraction and the adapters over the test tables."""
