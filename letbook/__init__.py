"""Listings analytics as lazy Spark DataFrames and Structured Streaming jobs."""

__version__ = "0.1.0"
