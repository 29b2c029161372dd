"""Structured Streaming queries and their runner."""
