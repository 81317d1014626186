"""Build and rank link graphs with Spark DataFrames."""
