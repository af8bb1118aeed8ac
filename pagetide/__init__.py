"""Operators over paged, nested JSON feeds, written on Spark DataFrames."""
