"""Keyed daily series analytics on Spark DataFrames."""
