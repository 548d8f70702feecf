"""Operators on DataFrames: grid fill, joins, dedup, gates, look-back, partitions, exports, zones."""
