"""Operators on DataFrames: latest-per-key, upsert, joins, aggregates, checks, layout."""
