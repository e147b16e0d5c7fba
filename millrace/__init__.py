"""Lakehouse table and topic jobs written on DataFrames, Spark SQL and Structured Streaming."""
