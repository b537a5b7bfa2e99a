"""Network-operations analytics on Spark DataFrames."""
