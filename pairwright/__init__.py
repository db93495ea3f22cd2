"""Data quality and record matching on Spark DataFrames."""
