"""Data-quality checks for daily fact and snapshot tables, as Spark DataFrames."""
