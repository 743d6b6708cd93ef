"""Structured Streaming jobs: scoring arriving requests and prediction metrics over time."""
