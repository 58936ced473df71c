"""Structured Streaming jobs: parsing, windows, enrichment and sinks."""
