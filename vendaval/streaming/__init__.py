"""Structured Streaming jobs: enrichment, windows, change feeds."""
