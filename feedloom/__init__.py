"""Feed loading and data-quality operators for Spark DataFrames."""
