"""Structured Streaming over landed batch files."""
