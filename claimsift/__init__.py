"""Bulk scoring of return claims with Spark DataFrames."""
