"""Structured Streaming front end of the publication operators."""
