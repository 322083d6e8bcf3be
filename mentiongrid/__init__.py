"""Counts of place and topic mentions in large dated text archives, on Spark."""
