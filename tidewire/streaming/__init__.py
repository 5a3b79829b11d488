"""Structured Streaming over the same operators (an addition: the data model itself is batch)."""
