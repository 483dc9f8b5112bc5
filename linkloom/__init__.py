"""Link and page intelligence on Spark DataFrames."""
