"""Structured Streaming over the drop zone."""
