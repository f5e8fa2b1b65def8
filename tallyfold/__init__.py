"""Entity-sentiment analytics on Spark DataFrames."""
