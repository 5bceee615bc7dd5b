"""Structured Streaming jobs over landed detection files."""
