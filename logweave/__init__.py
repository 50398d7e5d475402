"""Partitioned-log analytics on Spark DataFrames and Structured Streaming."""
