"""Landed files, lookups, raw loads and stored tables."""
