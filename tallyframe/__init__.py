"""Frames, expressions and SQL with explicit order and null rules, on Spark DataFrames."""
