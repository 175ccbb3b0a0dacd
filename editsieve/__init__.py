"""Edit-stream bot filtering and short-text similarity on Spark DataFrames."""
