"""Streaming forms of the aggregations."""
