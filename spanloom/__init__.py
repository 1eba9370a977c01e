"""Distributed-tracing analytics on Spark DataFrames."""
