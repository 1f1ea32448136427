"""isobar: multi-provider weather analytics on Spark DataFrames, SQL and Structured Streaming."""
