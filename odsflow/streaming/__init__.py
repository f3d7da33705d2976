"""Structured Streaming jobs: delimited append and change upsert."""
