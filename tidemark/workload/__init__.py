"""Queries over the test tables: fixtures, Spark side and SQL side."""
