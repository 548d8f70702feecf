"""Dated-table, weekly-grid and zone-join jobs on PySpark DataFrames."""
