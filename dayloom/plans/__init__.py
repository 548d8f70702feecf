"""Whole jobs, and the named queries with the SQL they are checked against."""
