"""Price-observation analytics on Spark DataFrames and Structured Streaming."""
