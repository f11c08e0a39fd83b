"""Layered processing of labeled short texts on Spark DataFrames."""
