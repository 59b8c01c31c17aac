"""Readers and parsers for what lands: objects, CSV files, sidecars, catalogs, feeds, payloads."""
