"""Scans: files, tables, ranges and zone features."""
