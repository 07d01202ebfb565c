"""Readers, writers and Python data sources."""
