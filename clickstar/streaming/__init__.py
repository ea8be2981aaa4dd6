"""Structured Streaming jobs: file arrival, increments and state kept in tables."""
