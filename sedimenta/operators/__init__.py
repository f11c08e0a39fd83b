"""Operators on whole DataFrames: de-duplication, merges, ranks, joins, metrics, models."""
