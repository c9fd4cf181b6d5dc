"""Campaign decisioning on Spark DataFrames."""
