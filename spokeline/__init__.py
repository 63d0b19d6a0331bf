"""Station availability analytics on Spark DataFrames and Structured Streaming."""
