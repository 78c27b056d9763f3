"""Table quality rules, marts and metrics on Spark DataFrames."""
